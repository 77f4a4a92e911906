import gzip
import hashlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.llm import warc
from salesmart.llm.queries import archived_pages
from salesmart.llm.tables import Workspace

PAGES = "page_id LONG, url STRING, html STRING, uri INT, block STRING"
LONG = "<p>" + "ü" * 60


def pages():
    rows = [
        (4, "http://a.example/x y\n", LONG, 1, "z"),
        (2, None, LONG, 1, "z"),
        (9, "", LONG, 1, "z"),
        (None, "http://a.example/", LONG, 1, "z"),
        (5, "http://b.example/", "short", 1, "z"),
        (6, "http://b.example/", "short", 1, None),
        (7, "http://c.example/", None, None, "z"),
        (8, "http://c.example/", "", 1, "z"),
        # Payloads that look like what stands between records.
        (10, "u", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nfiledesc://x 0.0.0.0 2 text/plain 9\n" * 3, 1, "z"),
        (11, "u", "\r\n\n" * 50, 1, "z"),
        (12, "u", "\n\r\r\n" * 50, 1, "z"),
        (13, "u", "y" * 3_000_000, 1, "z"),
        (15, "u", "y" * 3_000_000, 1, "z"),
        (None, "n", "only without numbers" * 9, 1, "z"),
        (None, "m", "only without numbers" * 9, 1, "z"),
    ]
    return [*rows, rows[0], (2, "other", LONG, 1, "z")] + [(100 + i, f"u{i}", "copy " * 40, 1, "z") for i in range(60)]


def expected(rows):
    first = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    found = []
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        least = first.get(html or "")
        later = len(body) >= 100 and least is not None and page_id != least
        found.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", least if later else None))
    return sorted(found, key=repr)


def test_pages_come_back(spark):
    """Nulls, ties, repeated rows, a long page, other columns with names used inside."""
    found = archived_pages(spark.createDataFrame(pages(), PAGES))
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(pages())


def test_hot_payloads_are_looked_up_by_broadcast_and_others_by_join(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT", 2)
    found = archived_pages(spark.createDataFrame(pages(), PAGES))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(pages())


def test_no_pages(spark):
    assert archived_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_old_lines_of_version_1():
    body = b"1 0 Old Archive\nURL IP-address Archive-date Content-type Archive-length\n\n"
    text = (
        b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain %d\n" % len(body) + body
        + b"http://x.example/with blank 192.0.2.7 199701020304 text/html 30\n"
        + b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\n"
        + b"dns:x.example 192.0.2.7 19970102030405 text/dns 9\nx A 1.2.3\n"
    )
    found = list(warc.arc_records(io.BytesIO(text), "old"))
    assert [r.version for r in found] == [1, 1, 1]
    page, name = found[1:]
    assert page.fields["URL"] == "http://x.example/with blank" and page.fields["IP-address"] == "192.0.2.7"
    assert warc.split_http(page.block) == (b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n", b"body\n")
    assert name.block == b"x A 1.2.3" and warc.split_http(name.block) == (b"", b"x A 1.2.3")


def test_lines_of_version_2_and_archives_on_end():
    body = b"2 0 Archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    second = (
        b"filedesc://new.arc 0.0.0.0 19980101 text/plain 200 - - 0 new.arc %d\n" % len(body) + body
        + b"http://y.example/ 192.0.2.8 19980102030405 image/gif 200 abc - 17 new.arc 3\nGIF\n"
    )
    first = b"http://no.example/ 192.0.2.8 1998 text/plain 2\nhi\n"
    found = list(warc.arc_records(io.BytesIO(first + second), "new"))
    assert [(r.version, r.block) for r in found] == [(1, b"hi"), (2, body), (2, b"GIF")]
    assert found[2].fields["Checksum"] == "abc" and found[2].fields["Archive-date"] == "19980102030405"


@pytest.mark.parametrize("text", [b"http://x 1 2 text/html 30\nshort\n", b"no line at all\n", b"u i d m -5\n", b"filedesc://x 0 1 t 7\n9 0 odd\n"])
def test_damaged_archives_raise(text):
    with pytest.raises(ValueError):
        list(warc.arc_records(io.BytesIO(text), "bad"))


@pytest.mark.parametrize(
    "digits, moment",
    [("20010203040506", "2001-02-03T04:05:06Z"), ("200102030405", "2001-02-03T04:05:00Z"), ("1997", "1997-01-01T00:00:00Z"), ("odd", "1970-01-01T00:00:00Z")],
)
def test_moments(digits, moment):
    assert warc.iso_moment(digits) == moment


def test_bytes_that_are_no_text_survive(spark, folder):
    """A picture in a plain and in a packed archive, with a copy, through both formats."""
    picture = bytes(range(256)) * 3
    block = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\nContent-Length: %d\r\n\r\n" % len(picture) + picture
    one = b"http://a.example/p 192.0.2.1 20010101000000 image/png %d\n" % len(block) + block + b"\n"
    two = b"http://b.example/p 192.0.2.1 20020101000000 image/png %d\n" % len(block) + block + b"\n"
    other = b"ftp://c.example/p 192.0.2.1 20020101000000 image/png %d\n" % len(picture) + picture + b"\n"
    Path(folder, "arc").mkdir()
    Path(folder, "arc", "a.arc").write_bytes(one)
    Path(folder, "arc", "b.arc.gz").write_bytes(gzip.compress(two) + gzip.compress(other))
    warc.convert_arc(spark, [f"{folder}/arc"], f"{folder}/warc", Workspace(spark, "test"))
    found = {r["uri"]: r for r in warc.read_warc(spark, f"{folder}/warc").collect()}
    first, second, third = (found[f"{u}.example/p"] for u in ("http://a", "http://b", "ftp://c"))
    assert bytes(first["payload"]) == picture and first["record_type"] == "response" and first["moment"] == "2001-01-01T00:00:00Z"
    assert second["record_type"] == "revisit" and second["refers_to_id"] == first["record_id"]
    assert second["payload_bytes"] == len(picture) and second["payload_digest"] == first["payload_digest"] and not second["payload"]
    assert third["record_type"] == "resource" and bytes(third["payload"]) == picture
    raw = gzip.decompress(next(p for p in Path(folder, "warc").glob("part-*") if b"response" in gzip.decompress(p.read_bytes())).read_bytes())
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")


def test_a_second_conversion_gives_the_same_identifiers(spark, folder):
    frame = spark.createDataFrame([("http://a.example/", "-", "20010101", "text/html", bytearray(b"x"))], "uri STRING, ip STRING, moment STRING, mime STRING, block BINARY")
    warc.write_arc(frame, f"{folder}/arc", 2)
    for n in (1, 2):
        warc.convert_arc(spark, [f"{folder}/arc"], f"{folder}/warc{n}", Workspace(spark, "test"))
    ids = [{r["record_id"] for r in warc.read_warc(spark, f"{folder}/warc{n}").filter("record_type = 'resource'").collect()} for n in (1, 2)]
    assert ids[0] == ids[1] and all(i.startswith("urn:uuid:") for i in ids[0])


def test_a_changed_payload_is_found(spark, folder):
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    Path(folder, "x.warc").write_bytes(record)
    with pytest.raises(Exception, match="not the payload"):
        warc.read_warc(spark, f"{folder}/x.warc").collect()


def test_addresses_hold_no_blanks(spark):
    frame = spark.createDataFrame([("a b\tc",), ("",), (None,)], "url STRING").select(warc.plain_uri(F.col("url")))
    assert [r[0] for r in frame.collect()] == ["a%20b%09c", "-", "-"]
