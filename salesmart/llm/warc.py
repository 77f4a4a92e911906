"""Legacy ARC archives, and their conversion into WARC archives.

An archive is a set of gzip files in one folder of any store that Spark reads and
writes. Files of bounded size are written by Spark's own text writer, a record a
row, so a lost executor costs repeated tasks only.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from functools import reduce
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace, ship_package

# The fields of a record line by version of the format, the length last.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of records between two version blocks, and version blocks a file.
SECTION_BYTES, SECTIONS = 1 << 20, 32
# Bytes of payloads that a task hands on at once.
BATCH_BYTES = 8 << 20
# Payloads that hold one in so many records or more are looked up by broadcast: at most so many rows.
HOT = 1000
ORIGIN = "legacy"

CAPTURE = (
    "kind string, archive string, position long, version int, uri string, ip string, moment string,"
    " mime string, head binary, payload binary, payload_bytes long, payload_digest string"
)


class ArcRecord(NamedTuple):
    """position: byte in the unpacked file. fields: by the names of the version's definition."""

    position: int
    version: int
    fields: dict[str, str]
    block: bytes


def version_block(version: int, moment: str, name: str) -> bytes:
    """The start of an archive: its description, version and definition of record lines."""
    body = f"{version} 0 {ORIGIN}\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return record_line(version, f"filedesc://{name}", "0.0.0.0", moment, "text/plain", name, len(body)) + body


def record_line(version: int, uri: str, ip: str, moment: str, mime: str, name: str, length: int) -> bytes:
    more = "" if version == 1 else f"200 - - 0 {name} "
    return f"{uri} {ip} {moment} {mime} {more}{length}\n".encode()


def plain_uri(uri: Column) -> Column:
    """An address without blanks and control characters, which end a field; ``-`` for none."""
    signs = [chr(i) for i in range(0x21)] + ["\x7f"]
    escaped = reduce(lambda text, sign: F.replace(text, F.lit(sign), F.lit(f"%{ord(sign):02X}")), signs, uri)
    return F.when(F.coalesce(F.length(uri), F.lit(0)) > 0, escaped).otherwise("-")


def write_arc(captures: DataFrame, path: str, version: int) -> None:
    """Write ``uri, ip, moment, mime`` (texts without blanks) and ``block`` (bytes) as an archive.

    ``moment`` has 14 digits. Every section of about a megabyte starts with a version
    block, so each file is an archive of its own; a file holds ``SECTIONS`` of them.
    """
    ship_package(captures.sparkSession)

    def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if not parts:
                    parts.append(version_block(version, row["moment"], "section.arc"))
                line = record_line(version, row["uri"], row["ip"], row["moment"], row["mime"], "section.arc", len(row["block"]))
                parts.append(line + row["block"])
                size += len(parts[-1])
                if size >= SECTION_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["section"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["section"])

    (
        captures.select("uri", "ip", "moment", "mime", "block")
        .mapInArrow(sections, "section binary")
        .select(F.col("section").cast("string"))
        .write.option("compression", "gzip")
        .option("maxRecordsPerFile", SECTIONS)
        .text(path)
    )


def opened(content: bytes) -> BinaryIO:
    """The unpacked bytes as a stream; also of several packed members on end."""
    packed = io.BytesIO(content)
    return gzip.GzipFile(fileobj=packed) if content[:2] == b"\x1f\x8b" else packed


def line_of(stream: BinaryIO) -> bytes:
    """The next line that is not empty, without its end; empty at the end of the stream."""
    while line := stream.readline():
        if line := line.rstrip(b"\r\n"):
            return line
    return b""


def block_of(stream: BinaryIO, length: str | bytes, where: str) -> bytes:
    wanted = int(length)
    block = stream.read(wanted)
    if len(block) < wanted:
        raise ValueError(f"{where}: {wanted} bytes declared, {len(block)} there")
    return block


def arc_records(stream: BinaryIO, name: str) -> Iterator[ArcRecord]:
    """The records of an archive, version blocks included.

    A version block says which fields the lines after it have, by its definition or
    by its number; without one the number of fields tells the version. The first
    field may hold blanks, the others not. Blocks are cut by their declared lengths
    alone, whatever they hold. A line or length that fits no version raises.
    """
    version, fields = 0, ()
    while line := line_of(stream):
        position = stream.tell()
        where = f"{name}, before byte {position}"
        if line.startswith(b"filedesc://"):
            body = block_of(stream, line.rsplit(b" ", 1)[1], where)
            first, _, rest = body.partition(b"\n")
            version = int(first.split()[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{where}: version {version}")
            fields = tuple(rest.decode("utf-8", "replace").split("\n")[0].split()) or ARC_FIELDS[version]
            described = line.decode("utf-8", "replace").rsplit(" ", len(ARC_FIELDS[version]) - 1)
            yield ArcRecord(position, version, dict(zip(ARC_FIELDS[version], described, strict=False)), body)
            continue
        if not fields:
            version = 2 if line.count(b" ") >= len(ARC_FIELDS[2]) - 1 else 1
            fields = ARC_FIELDS[version]
        values = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(values) < len(fields) or not values[-1].isdigit():
            raise ValueError(f"{where}: no record line of version {version}: {line[:200]!r}")
        yield ArcRecord(position, version, dict(zip(fields, values, strict=True)), block_of(stream, values[-1], where))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The head of an HTTP response with the empty line that ends it, and the payload.

    A block that is no HTTP response is all payload.
    """
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(at, len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := block.find(mark)) >= 0]
    if not ends:
        return block, b""
    at, length = min(ends)
    return block[: at + length], block[at + length :]


def http_headers(head: bytes) -> dict[str, str]:
    """The fields of an HTTP or WARC head, names in lower case; the last of a name counts."""
    pairs = (line.partition(b":") for line in head.splitlines()[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, mark, v in pairs if mark}


def iso_moment(digits: str) -> str:
    """A WARC date of an ARC date of 4 to 14 digits; what is missing is the start of its span."""
    if not digits.isdigit() or not 4 <= len(digits) <= 14:
        digits = "1970"
    full = digits + "00000101000000"[len(digits) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:]}Z"


def in_batches(rows: Iterator[tuple], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``BATCH_BYTES`` by the bytes in column ``weight``."""
    some: list[tuple] = []
    size = 0
    for row in rows:
        some.append(row)
        size += len(row[weight] or b"") + 200
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def files(spark: SparkSession, *paths: str) -> DataFrame:
    ship_package(spark)
    return spark.read.format("binaryFile").load(list(paths)).select("path", "content")


def read_arc(spark: SparkSession, *paths: str, bodies: bool = True) -> DataFrame:
    """The records of archives as ``CAPTURE``; without ``bodies``, heads only.

    ``kind`` is ``warcinfo`` for a version block, ``response`` for an HTTP block and
    ``resource`` for any other.
    """
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in CAPTURE.split(", "))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                name = path.rsplit("/", 1)[-1]
                for record in arc_records(opened(content.as_py()), name):
                    described = record.fields["URL"].startswith("filedesc://")
                    head, payload = (b"", record.block) if described else split_http(record.block)
                    yield (
                        "warcinfo" if described else "response" if head else "resource",
                        name,
                        record.position,
                        record.version,
                        record.fields["URL"],
                        record.fields.get("IP-address", "-"),
                        iso_moment(record.fields.get("Archive-date", "")),
                        record.fields.get("Content-type", "-"),
                        head,
                        payload if bodies else None,
                        len(payload),
                        hashlib.sha256(payload).hexdigest(),
                    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(rows(batches), schema, 9)

    return files(spark, *paths).mapInArrow(parse, CAPTURE)


def urn(*parts: Column) -> Column:
    """A record's identifier: a UUID (version 8) of the hash of what it is made of."""
    digest = F.sha2(F.concat(*[F.coalesce(p, F.lit(b"")) for p in parts]), 256)
    pieces = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("8"), F.substring(digest, 14, 3)),
              F.concat(F.lit("a"), F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *pieces))


def record_id() -> Column:
    return urn(F.col("uri").cast("binary"), F.col("moment").cast("binary"), F.col("payload_digest").cast("binary"), F.col("head"))


def spread_lookup(rows: DataFrame, found: DataFrame, key: str, weight: str, total: int, unique: Column) -> DataFrame:
    """``rows`` left-joined with ``found``, one row a ``key``, by that column of both.

    Keys with one in ``HOT`` of all rows or more, by the counts in ``weight``, are at most
    ``HOT`` and broadcast. Rows with another key or none meet theirs in a join; the rows
    of hot keys, which have nothing to meet there, are spread by ``unique``.
    """
    columns = [c for c in found.columns if c not in (key, weight)]
    hot = found.filter(F.col(weight) * HOT >= total)
    rare = found.filter(F.col(weight) * HOT < total)
    hot = hot.select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in columns])
    rare = rare.select(F.col(key).alias("_rare"), *[F.col(c).alias(f"_rare_{c}") for c in columns])
    apart = F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), F.concat(F.lit("-"), unique.cast("string"))).otherwise(F.col(key))
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_apart", apart)
    met = met.join(rare, F.col("_apart") == F.col("_rare"), "left")
    return met.select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_rare_{c}").alias(c) for c in columns])


def field(name: str, value: Column | str) -> Column:
    """A line of a record's head; none where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(captures: DataFrame, path: str) -> None:
    """Write the rows of ``typed_captures`` as WARC records, revisits without payload."""
    revisit, info = F.col("record_type") == "revisit", F.col("record_type") == "warcinfo"
    described = F.concat(
        F.lit("software: salesmart\r\nformat: WARC File Format 1.1\r\nisPartOf: "),
        "archive",
        F.lit("\r\ndescription: converted from ARC version "),
        F.col("version").cast("string"),
        F.lit("\r\n"),
    )
    block = (
        F.when(info, described.cast("binary"))
        .when(revisit, F.col("head"))
        .otherwise(F.concat("head", F.coalesce("payload", F.lit(b""))))
    )
    mime = F.when(F.col("mime") == "-", "application/octet-stream").otherwise(F.col("mime"))
    kind = (
        F.when(info, "application/warc-fields")
        .when(F.col("record_type") == "resource", mime)
        .otherwise("application/http; msgtype=response")
    )
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        field("WARC-Date", F.col("moment")),
        field("WARC-Target-URI", F.when(~info & (F.col("uri") != "-"), F.col("uri"))),
        field("WARC-IP-Address", F.when(~info & ~F.col("ip").isin("-", "0.0.0.0"), F.col("ip"))),
        field("WARC-Profile", F.when(revisit, F.lit(SAME_PAYLOAD))),
        field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), "first_id", F.lit(">")))),
        field("WARC-Refers-To-Target-URI", F.when(revisit & (F.col("first_uri") != "-"), F.col("first_uri"))),
        field("WARC-Refers-To-Date", F.when(revisit, F.col("first_moment"))),
        field("WARC-Payload-Digest", F.when(~info, F.concat(F.lit("sha256:"), "payload_digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        field("Content-Type", kind),
        field("Content-Length", F.octet_length("block").cast("string")),
    )
    # The writer ends each row with a line feed, the last of the two line ends after a block.
    whole = F.concat(head.cast("binary"), F.lit(b"\r\n"), F.col("block"), F.lit(b"\r\n\r"))
    captures.withColumn("block", block).select(whole.cast("string").alias("record")).write.option("compression", "gzip").text(path)


def typed_captures(captures: DataFrame, heads: DataFrame, work: Workspace, order: Column, least_bytes: int) -> DataFrame:
    """``captures`` with ``record_id``, ``record_type`` and, for revisits, whom they refer to.

    Of HTTP responses with equal payloads of at least ``least_bytes``, those first by
    ``order`` (null last) stay what they are and the others revisit one of them.
    ``heads`` are the same captures without payloads.
    """
    able = (F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes)
    candidate = F.struct(order.isNull(), order, record_id(), "uri", "moment")
    groups = work.stored(
        heads.filter(able)
        .groupBy("payload_digest")
        .agg(F.min(candidate).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "n", F.col("first").cast(
            f"struct<none: boolean, place: {captures.select(order).schema[0].dataType.simpleString()},"
            " first_id: string, first_uri: string, first_moment: string>"
        ).alias("first"))
        .select("payload_digest", "n", "first.*"),
        "groups",
    )
    total = groups.agg(F.sum("n")).first()[0] or 0
    met = spread_lookup(
        captures.withColumn("record_id", record_id()), groups, "payload_digest", "n", total, F.xxhash64("archive", "position")
    )
    later = able & F.coalesce(~F.col("none"), F.lit(False)) & ~order.eqNullSafe(F.col("place"))
    return met.withColumn("record_type", F.when(later, "revisit").otherwise(F.col("kind"))).drop("none", "place")


def convert_arc(
    spark: SparkSession, arcs: list[str], path: str, work: Workspace, order: Column | None = None, least_bytes: int = 100
) -> None:
    """Convert ARC archives of any versions into WARC archives in the folder ``path``.

    Each record keeps its address, IP, moment (a WARC date), HTTP head and payload. It
    gets an identifier made of all these, so that a conversion run again gives the
    same, SHA-256 digests of payload and block, and a type: ``warcinfo`` for a version
    block, ``response`` for an HTTP response, ``resource`` for anything else, and
    ``revisit`` for a response whose payload of at least ``least_bytes`` another one
    has that comes first by ``order`` (of ``CAPTURE``; by default the moment). Those
    that tie for the first place all stay responses.

    The archives are read twice: once for the digests, which alone are grouped, and
    once to write. A digest that very many share is looked up by broadcast
    (``spread_lookup``). An archive that breaks its declared lengths raises.
    """
    order = F.col("moment") if order is None else order
    heads = read_arc(spark, *arcs, bodies=False)
    write_warc(typed_captures(read_arc(spark, *arcs), heads, work, order, least_bytes), path)


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def warc_records(stream: BinaryIO, name: str) -> Iterator[WarcRecord]:
    """The records of a WARC archive, cut by their declared lengths."""
    while line := line_of(stream):
        where = f"{name}, before byte {stream.tell()}"
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{where}: no record: {line[:200]!r}")
        head = [line]
        while (line := stream.readline().rstrip(b"\r\n")):
            head.append(line)
        headers = http_headers(b"\n".join(head))
        yield WarcRecord(headers, block_of(stream, headers.get("content-length", "0"), where))


RECORD = (
    "record_type string, record_id string, refers_to_id string, uri string, moment string,"
    " http_headers map<string,string>, payload binary, payload_bytes long, payload_digest string"
)


def read_warc(spark: SparkSession, *paths: str, bodies: bool = True) -> DataFrame:
    """The records of WARC archives as ``RECORD``, ``payload`` only with ``bodies``.

    A payload that is there must have the digest its record declares, else this
    raises. Size and digest are of the full payload: a revisit's are those it declares.
    """
    schema = pa.schema(
        [(n, pa.string()) for n in ("record_type", "record_id", "refers_to_id", "uri", "moment")]
        + [("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                for headers, block in warc_records(opened(content.as_py()), path):
                    kind, declared = headers.get("warc-type"), headers.get("warc-payload-digest")
                    head, payload = split_http(block)
                    http = http_headers(head)
                    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                    if kind == "revisit":
                        digest, size = (declared or "").removeprefix("sha256:"), http.get("content-length", "")
                        size = int(size) if size.isdigit() else None
                    elif declared not in (None, f"sha256:{digest}"):
                        raise ValueError(f"{path}: {headers.get('warc-record-id')} is not the payload it declares")
                    yield (
                        kind,
                        headers.get("warc-record-id", "").strip("<>"),
                        headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
                        headers.get("warc-target-uri"),
                        headers.get("warc-date"),
                        list(http.items()),
                        payload if bodies else None,
                        size,
                        digest,
                    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(rows(batches), schema, 6)

    return files(spark, *paths).mapInArrow(parse, RECORD)
