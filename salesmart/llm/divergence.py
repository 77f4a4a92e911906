"""How the sources of a language differ in their words."""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.perfect_hash import Levels, PerfectHash, built, key_hashes
from salesmart.llm.tables import Workspace

# Everything but letters and signs beyond ASCII parts terms; A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
# Shares are counted in billionths.
UNIT = 1_000_000_000
# A term's slot is its shard's number above these bits and its place in the shard below.
SLOT_BITS = 32


class DivergenceSettings(NamedTuple):
    """least_documents: of a language that hold a term, for it to be kept. ranks: of the
    terms that set a source apart. shard_terms: terms of a perfect hash, about.
    round_bytes: of the hashes broadcast at once; beyond it the documents are counted
    in several rounds. task_bytes: of the counts a task holds, and of the text it
    counts before it hands terms on. block, tile: terms and sources compared at once."""

    least_documents: int = 3
    ranks: int = 200
    shard_terms: int = 50_000
    round_bytes: int = 64 << 20
    task_bytes: int = 64 << 20
    block: int = 2048
    tile: int = 128


def terms_of(text: str | None) -> list[bytes]:
    r"""Terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z in lower case."""
    return (text or "").encode().translate(TERM_BYTES).split()


def kept_terms(documents: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """The terms of each language that at least ``least_documents`` rows hold, counted exactly."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        seen = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                if found:
                    terms = pa.array([t.decode() for t in found], pa.string())
                    numbers = pa.array(found.values(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(found)), terms, numbers], ["lang", "term", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                text = text.as_py()
                counts[lang].update(set(terms_of(text)))
                seen += len(text or "")
                if seen >= settings.task_bytes:
                    yield from emptied()
                    seen = 0
        yield from emptied()
        # Workers live on: what has been freed goes back to the system.
        pa.default_memory_pool().release_unused()

    return (
        documents.select("lang", "text")
        .mapInArrow(counted, "lang string, term string, n long")
        # Terms leave a task counted, so that adding up before the shuffle would spare no row.
        .repartition("lang", "term")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= settings.least_documents)
        .select("lang", "term")
    )


def hashed_shards(kept: DataFrame, sizes: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """Perfect hashes over the kept terms: a language is cut into shards by a hash of the
    term, and each shard is one group. ``terms`` are in the order of their numbers."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [t.encode() for t in batch["term"].to_pylist()]
            shards = np.maximum(1, -(-batch["v"].to_numpy() // settings.shard_terms))
            shard = key_hashes(keys)[:, 0] % shards.astype(np.uint64) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], pa.array(shard.astype(np.int64)), batch["term"]], ["lang", "shard", "term"]
            )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        terms = np.sort(group["term"].to_numpy(object))
        levels, numbers = built(key_hashes([t.encode() for t in terms])[:, 1])
        ordered = np.empty(len(terms), object)
        ordered[numbers] = terms
        row = {"lang": group["lang"].iloc[0], "shard": group["shard"].iloc[0], "sizes": levels.sizes, "bits": levels.bits, "terms": ordered}
        return pd.DataFrame([row])

    return (
        kept.join(sizes, "lang")
        .select("lang", "term", "v")
        .mapInArrow(dealt, "lang string, shard long, term string")
        .groupBy("lang", "shard")
        .applyInPandas(build, "lang string, shard long, sizes array<int>, bits binary, terms array<string>")
    )


class Numbered(dict):
    """Distinct terms and their numbers, in the order in which they are asked for."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class Recount:
    """A worker's lookup of terms in the hashes of a round, and what it remembers of them."""

    def __init__(self, rows: list[tuple]):
        self.shards: dict[str, tuple[int, dict[int, PerfectHash]]] = {}
        for lang, of_lang, shard, sizes, bits, text in rows:
            self.shards.setdefault(lang, (of_lang, {}))[1][shard] = PerfectHash(Levels(sizes, bits), text.encode())
        self.known: dict[str, Numbered] = defaultdict(Numbered)
        self.found: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(0, np.int64))
        self.held = 0

    def slots(self, lang: str) -> np.ndarray:
        """By their numbers, the slots of all known terms, -1 for those this round does not
        count. Terms are looked up here, once, whichever task first met them."""
        of_lang, hashes = self.shards[lang]
        known, before = self.known[lang], self.found[lang]
        fresh = list(islice(known, len(before), None))
        if fresh:
            keys = key_hashes(fresh)
            shard = (keys[:, 0] % np.uint64(of_lang)).astype(np.int64)
            found = np.full(len(fresh), -1, np.int64)
            for number, perfect in hashes.items():
                at = np.flatnonzero(shard == number)
                places = perfect.numbers([fresh[i] for i in at.tolist()], keys[at, 1])
                found[at] = np.where(places >= 0, places + (number << SLOT_BITS), -1)
            self.found[lang] = np.concatenate([before, found])
            self.held += sum(map(len, fresh)) + 100 * len(fresh)
        return self.found[lang]

    def forget(self) -> None:
        """Start anew; numbers given so far mean nothing any more."""
        self.known.clear()
        self.found.clear()
        self.held = 0


_kept: dict[str, Recount] = {}


def worker_recount(token: str, shards: Broadcast) -> Recount:
    """The lookup of the round named by ``token``, which a worker keeps from task to task."""
    if token not in _kept:
        _kept.clear()
        _kept[token] = Recount(shards.value)
    return _kept[token]


def recounted(documents: DataFrame, rows: list[tuple], settings: DivergenceSettings) -> DataFrame:
    """How often each group (``lang, source``) holds the terms of the given shards, by slot.

    A task keeps a dense array of counts for each group and shard and adds one for
    each occurrence; only what is not zero leaves it.
    """
    shards, token = documents.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    dense = {(lang, shard): text.count(" ") + 1 for lang, _, shard, _, _, text in rows}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recount = worker_recount(token, shards)
        counts: dict[tuple[str, str, int], np.ndarray] = {}
        waiting: dict[tuple[str, str], list[np.ndarray]] = defaultdict(list)
        held = seen = fresh = total = 0

        def added() -> int:
            """Count what waits; returns the bytes of new arrays."""
            more = 0
            for (lang, source), parts in waiting.items():
                found, terms = recount.slots(lang), np.concatenate(parts)
                if len(terms) < len(found) // 8:
                    terms, numbers = np.unique(terms, return_counts=True)
                else:
                    numbers = np.bincount(terms)
                    terms = np.flatnonzero(numbers)
                    numbers = numbers[terms]
                slots = found[terms]
                numbers, slots = numbers[slots >= 0], slots[slots >= 0]
                shard = slots >> SLOT_BITS
                for number in np.unique(shard).tolist():
                    key = (lang, source, number)
                    if key not in counts:
                        counts[key] = np.zeros(dense[lang, number], np.int32)
                        more += counts[key].nbytes
                    here = shard == number
                    # Terms are distinct, so their slots are.
                    counts[key][slots[here] & ((1 << SLOT_BITS) - 1)] += numbers[here].astype(np.int32)
            waiting.clear()
            if recount.held > settings.task_bytes:
                recount.forget()
            return more

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, source, number), found in counts.items():
                at = np.flatnonzero(found)
                slots = pa.array(at + (number << SLOT_BITS), pa.int64())
                numbers = pa.array(found[at].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(at)), pa.repeat(source, len(at)), slots, numbers], ["lang", "source", "slot", "n"]
                )
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
                if lang not in recount.shards:
                    continue
                terms, known = terms_of(text.as_py()), recount.known[lang]
                before = len(known)
                waiting[lang, source].append(np.fromiter(map(known.__getitem__, terms), np.int32, len(terms)))
                fresh += len(known) - before
                seen += len(terms)
                total += len(terms)
                if seen >= settings.task_bytes // 32 or fresh >= settings.task_bytes // 256:
                    held, seen, fresh = held + added(), 0, 0
                    if held >= settings.task_bytes or total >= 1 << 30:
                        yield from emptied()
                        held = total = 0
        added()
        yield from emptied()
        pa.default_memory_pool().release_unused()

    found = documents.mapInArrow(counted, "lang string, source string, slot long, n long")
    # Hardly a slot comes twice from a task, so that adding up before the shuffle would spare no row.
    return found.repartition("lang", "source", "slot").groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + v)), exactly."""
    return 1 + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + v).cast("decimal(20,0)"))


def differing(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def rounds_of(sizes: list[int], room: int) -> Iterator[tuple[int, int]]:
    """Ranges of items, as first and last, of at most ``room`` together, or of one item."""
    first = held = 0
    for i, size in enumerate(sizes):
        if i > first and held + size > room:
            yield first, i - 1
            first, held = i, 0
        held += size
    if sizes:
        yield first, len(sizes) - 1


def counted_in_rounds(documents: DataFrame, shards: DataFrame, work: Workspace, settings: DivergenceSettings) -> DataFrame:
    """``recounted`` over all shards, of which each round broadcasts ``round_bytes`` at most."""
    spark = documents.sparkSession
    text = F.array_join("terms", " ")
    listed = (
        shards.select("lang", "shard", (F.octet_length("bits") + F.octet_length(text)).alias("bytes")).orderBy("lang", "shard").collect()
    )
    counts = spark.createDataFrame([], "lang string, source string, slot long, n long")
    key = F.struct("lang", "shard")
    for number, (first, last) in enumerate(rounds_of([row["bytes"] for row in listed], settings.round_bytes)):
        low, high = (F.struct(F.lit(listed[i]["lang"]).alias("lang"), F.lit(listed[i]["shard"]).alias("shard")) for i in (first, last))
        rows = shards.filter((key >= low) & (key <= high)).select("lang", "of_lang", "shard", "sizes", "bits", text)
        found = recounted(documents, [tuple(row) for row in rows.collect()], settings)
        counts = counts.unionByName(work.stored(found, f"counts-{number}"))
    return counts


def pair_sums(shares: DataFrame, base: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """For sources ``a`` and ``b`` of a language, by their numbers, the sum of ``differing``
    over the terms that were compared, and how many these are.

    Terms go in blocks and sources in tiles, and a group is one block with two tiles:
    a matrix of bounded size. Terms that neither of its tiles holds are not in it.
    """
    tile = F.floor(F.col("number") / settings.tile)
    block = F.struct(
        F.shiftright("slot", SLOT_BITS).alias("shard"),
        F.floor(F.col("slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) / settings.block).alias("part"),
    )
    rows = shares.select("lang", "number", "tiles", "slot", "p", block.alias("block"))
    # Each source's share of a term it does not hold, once a block.
    marks = rows.select("lang", "block").distinct().join(base.filter("v > 0"), "lang")
    rows = rows.unionByName(marks.select("lang", "number", "tiles", F.lit(-1).cast("long").alias("slot"), F.col("p0").alias("p"), "block"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    rows = rows.select("*", other.alias("other")).select(
        "lang", "block", F.least(tile, "other").alias("one"), F.greatest(tile, "other").alias("two"), "number", "slot", "p"
    )

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        marks = group["slot"].to_numpy() < 0
        numbers, row = np.unique(group["number"].to_numpy(), return_inverse=True)
        slots, column = np.unique(group["slot"].to_numpy()[~marks], return_inverse=True)
        p = group["p"].to_numpy()
        matrix = np.zeros((len(numbers), len(slots)), np.int64)
        matrix[row[marks]] = p[marks, None]
        matrix[row[~marks], column] = p[~marks]
        tiles, a, b, values = numbers // settings.tile, [], [], []
        one, two = group["one"].iloc[0], group["two"].iloc[0]
        for i in range(len(numbers)):
            others = np.flatnonzero((tiles != tiles[i]) | (one == two))
            others = others[others != i]
            step = max(1, (1 << 20) // max(1, len(slots)))
            for start in range(0, len(others), step):
                q = matrix[others[start : start + step]]
                values.append(((matrix[i] - q) ** 2 // q).sum(axis=1))
            a.append(np.full(len(others), numbers[i]))
            b.append(numbers[others])
        none = [np.zeros(0, np.int64)]
        found = {"a": np.concatenate(a + none), "b": np.concatenate(b + none), "value": np.concatenate(values + none)}
        return pd.DataFrame({"lang": group["lang"].iloc[0], **found, "n": len(slots)})

    sums = rows.groupBy("lang", "block", "one", "two").applyInPandas(compared, "lang string, a long, b long, value long, n long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))


def source_divergence(documents: DataFrame, settings: DivergenceSettings = DivergenceSettings()) -> DataFrame:
    """How far each (``lang``, ``source``) of ``documents`` is from the other sources of its
    language, and by which terms it differs from the language.

    1. Terms (``terms_of``) are counted once a row and language; those that at least
       ``least_documents`` rows of a language hold are kept, exactly.
    2. The kept terms of a language are cut into shards, each with a minimal perfect
       hash. The hashes and the terms themselves are broadcast, ``round_bytes`` at a
       time however many there are, and the documents are read again: a task adds
       every occurrence of a term, told from others by its stored text, to a dense
       array of its group.
    3. From the counts n of a group, their total N and the number V of kept terms,
       every kept term has the share p = 1 + floor(10**9 (n + 1) / (N + V)), held or not.
       The value f = floor((p - q)**2 / q) says how a share p differs from q.

    Returns ``lang, source, part, item, value, rank``. Part ``pair``: for each other
    source of the language, the sum of f over all kept terms, q being the other's. Part
    ``term``: for the terms that the group holds and whose p is above the language's q,
    f, the ``ranks`` largest. Rank is by value, downwards, then by item.

    A null text, lang or source counts as empty; a group without terms is compared all
    the same, and in a language without kept terms all values are 0. Repeated rows
    count as documents of their own. Other columns are ignored. Nothing that grows
    with the documents comes to the driver but one row a shard (of ``shard_terms``
    terms of a language).
    """
    spark: SparkSession = documents.sparkSession
    work = Workspace(spark, "divergence", lean=True)
    docs = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    groups = docs.select("lang", "source").distinct()
    kept = work.stored(kept_terms(docs, settings), "kept")
    sizes = work.stored(kept.groupBy("lang").agg(F.count("*").alias("v")), "sizes")
    shards = work.stored(hashed_shards(kept, sizes, settings), "shards")
    work.drop("kept")
    of_lang = F.ceil(F.col("v") / settings.shard_terms)
    counts = counted_in_rounds(docs, shards.join(sizes, "lang").withColumn("of_lang", of_lang), work, settings)

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    tiles = F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / settings.tile) + 1
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("long")
    base = work.stored(
        groups.join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"))
        .withColumn("number", numbered.cast("long"))
        .withColumn("tiles", tiles)
        .withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v")))),
        "base",
    )
    shares = work.stored(
        counts.join(base, ["lang", "source"]).select("lang", "source", "number", "tiles", "slot", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p")),
        "shares",
    )

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.withColumn("rank", F.row_number().over(order))

    of_terms = shards.select("lang", "shard", F.posexplode("terms").alias("place", "item")).select(
        "lang", (F.shiftleft("shard", SLOT_BITS) + F.col("place")).alias("slot"), "item"
    )
    in_lang = base.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    language = (
        shares.groupBy("lang", "slot").agg(F.sum("n").alias("n")).join(in_lang, "lang")
        .select("lang", "slot", share(F.col("n"), F.col("total"), F.col("v")).alias("q"))
        .join(of_terms, ["lang", "slot"])
    )
    terms = shares.join(language, ["lang", "slot"]).filter("p > q")
    terms = terms.select("lang", "source", "item", differing(F.col("p"), F.col("q")).alias("value"))

    one, two = base.select("lang", "source", "number", "v", "p0"), base.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("p0").alias("q0"))
    sums = pair_sums(shares, base, settings)
    pairs = (
        one.join(two, "lang").filter("number <> other")
        .join(sums.withColumnsRenamed({"a": "number", "b": "other"}), ["lang", "number", "other"], "left")
        .withColumn("rest", (F.col("v") - F.coalesce("n", zero)) * differing(F.col("p0"), F.col("q0")))
        .select("lang", "source", "item", (F.coalesce("value", zero) + F.coalesce("rest", zero)).alias("value"))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked_pairs = ranked(pairs).withColumn("part", F.lit("pair"))
    ranked_terms = ranked(terms).filter(F.col("rank") <= settings.ranks).withColumn("part", F.lit("term"))
    return ranked_pairs.select(columns).unionByName(ranked_terms.select(columns))
