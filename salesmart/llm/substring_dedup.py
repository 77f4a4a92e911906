"""Passages that repeat across documents, with a count-min prefilter."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace, bit_set, bitmap
from salesmart.llm.words import mixed, rolling, sliding_min, word_hashes, words_of

# Marks a document whose every word goes.
ALL = -1


class PassageSettings(NamedTuple):
    """window: words that make a passage. anchor: words of the runs that are counted in
    place of windows. rows: of the sketch. most_bits: a row that tasks hold has at most
    2**most_bits cells, of which they get one bit each; a larger one stays a table.
    id_bits: of the bitmaps that spare texts a shuffle, at most."""

    window: int = 50
    anchor: int = 25
    rows: int = 2
    most_bits: int = 28
    id_bits: int = 28


# Cells of a row for each anchor expected: a row held by tasks, and the single row of a table, where
# empty cells cost nothing. A lone anchor is suspected with 5 and 3 percent at most.
HELD_CELLS, TABLE_CELLS = 4, 32
# Bytes of a short word and the space after it.
WORD_BYTES = 4


def bits_for(cells: float) -> int:
    """The least power of two with that many cells."""
    return max(8, math.ceil(math.log2(max(cells, 1))))


def expected_anchors(n_bytes: int, settings: PassageSettings) -> float:
    """Anchors in so much text: of random hashes, two in each ``width + 1`` windows are a new minimum."""
    width = settings.window - settings.anchor + 1
    return n_bytes / WORD_BYTES * 2 / (width + 1)


def anchors(hashes: np.ndarray, settings: PassageSettings) -> tuple[np.ndarray, np.ndarray]:
    """For each window the least hash of the runs of ``anchor`` words in it.

    Equal windows have equal anchors, so an anchor is counted in at least as many
    documents as any window it stands for, while a text has far fewer of them.
    Returns the anchors in order, and for how many windows on end each stands.
    """
    runs = rolling(hashes, settings.anchor)
    width = settings.window - settings.anchor + 1
    if len(runs) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = sliding_min(runs, width)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.diff(np.append(starts, len(keys)))


def sketch_cells(keys: np.ndarray, rows: int, row_bits: int) -> np.ndarray:
    """The cell of each key in each row of the sketch, rows one after another."""
    cells = []
    for row in range(rows):
        place = mixed(keys + np.uint64(row * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(64 - row_bits)
        cells.append(place.astype(np.int64) + (row << row_bits))
    return np.stack(cells)


def suspected_cells(texts: DataFrame, repeated: DataFrame, settings: PassageSettings, row_bits: int) -> DataFrame:
    """``doc_id, text_key, often``: per document its cells of the single row that are in ``repeated``.

    A cell that a third of all documents share is one row of ``repeated`` and many of
    the other side, which AQE splits; what is gathered is bounded by a document's words.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.unique(sketch_cells(anchors(word_hashes().of(words_of(t.as_py()))[:, 0], settings)[0], 1, row_bits))
                for t in batch["text"]
            ]
            which = pa.array(np.repeat(np.arange(len(found)), [len(cells) for cells in found]), pa.int64())
            cells = pa.array(np.concatenate([np.zeros(0, np.int64), *found]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(which), batch["text_key"].take(which), cells], ["doc_id", "text_key", "cell"]
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return (
        texts.select("doc_id", "text_key", "text")
        .mapInArrow(placed, f"doc_id {kind}, text_key long, cell long")
        .join(repeated, "cell", "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("cell").alias("often"))
    )


def repeated_passages(
    documents: DataFrame, settings: PassageSettings = PassageSettings(), with_text: bool = False
) -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``): its words, and those left.

    A word goes when a window of ``window`` consecutive words covers it whose words
    also start in a document with a smaller ``doc_id``; all windows are those of the
    input.

    1. Every partition counts the anchors of its documents in a count-min sketch;
       the sketches are added up. They only overestimate, so a window whose anchor
       is estimated to occur once occurs once. The sketch grows with the bytes of
       the text. While a row has 2**most_bits cells or fewer, tasks hold a bit a cell;
       beyond, its cells stay a table, with which the anchors are joined.
    2. The other windows are grouped by a 128-bit hash of their words. Of documents
       with the very same text only that of the smallest id takes part; the others
       lose every window to it.
    3. The windows whose first document is another one mark their words.

    Texts travel only where a bitmap of the marked ids says they may be marked, and in
    step 2 where their suspected anchors come from a table. The bitmaps grow with the
    rows up to 2**id_bits; beyond, more texts travel. A null or empty text has no words. A document without an id neither
    loses words nor makes others lose any. Rows that repeat a ``doc_id`` are judged
    each by its own text, and lose nothing to one another.

    Returns ``doc_id, n_words, n_removed, kept_sha256`` (of the words left, joined by
    one space), and with ``with_text`` also ``kept_text``.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "passages")
    keyed = documents.select(
        "doc_id", "text", F.xxhash64("text").alias("text_key"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")
    )
    identified = keyed.filter("doc_id is not null and text is not null")
    size = identified.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    id_bits = min(settings.id_bits, bits_for(8 * size["rows"]))
    n_anchors = expected_anchors(size["bytes"] or 0, settings)
    row_bits = bits_for(HELD_CELLS * n_anchors)
    held = row_bits <= settings.most_bits
    sketch_rows = settings.rows if held else 1
    if not held:
        row_bits = bits_for(TABLE_CELLS * n_anchors)

    # Documents with the same text as one of a smaller id.
    groups = work.stored(
        identified.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last"),
        "groups",
    )
    copies = work.stored(
        identified.join(groups.select("digest", "first"), "digest").filter("doc_id > first").select("doc_id", "text_key").distinct(),
        "copies",
    )
    digest_cell = F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), 32 - id_bits)
    grouped = spark.sparkContext.broadcast(bitmap(groups.select(digest_cell), id_bits))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(anchors(word_hashes().of(words_of(t.as_py()))[:, 0], settings)[0]) for t in batch["text"]]
            found = np.concatenate(found) if found else np.zeros(0, np.uint64)
            cells, n = np.unique(sketch_cells(found, sketch_rows, row_bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.minimum(n, 2), pa.int32())], ["cell", "n"])

    sketch = identified.select("text").mapInArrow(counted, "cell long, n int").groupBy("cell").agg(F.sum("n").alias("n"))
    repeated = sketch.filter("n > 1").select("cell")
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = identified.select("doc_id", "text", "text_key", digest_cell.alias("cell"))
    if held:
        several = spark.sparkContext.broadcast(bitmap(repeated, row_bits + (sketch_rows - 1).bit_length()))
    else:
        texts = texts.join(suspected_cells(texts, repeated, settings, row_bits), ["doc_id", "text_key"])
    window_names = ["doc_id", "text_key", "in_group", "pos", "high", "low"]

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            in_group = bit_set(grouped.value, batch["cell"].to_numpy())
            which, spots, high, low = [], [], [], []
            for i, text in enumerate(batch["text"]):
                hashes = word_hashes().of(words_of(text.as_py()))
                keys, spans = anchors(hashes[:, 0], settings)
                cells = sketch_cells(keys, sketch_rows, row_bits)
                often = bit_set(several.value, cells).all(axis=0) if held else np.isin(cells[0], batch["often"][i].values)
                at = np.flatnonzero(np.repeat(often, spans))
                if len(at):
                    which.append(i)
                    spots.append(at)
                    high.append(rolling(hashes[:, 0], settings.window)[at])
                    low.append(rolling(hashes[:, 1], settings.window)[at])
            if which:
                ends = np.cumsum([0, *map(len, spots)])

                def ragged(parts: list[np.ndarray], ends=ends, kind=np.int64) -> pa.Array:
                    flat = np.concatenate(parts)
                    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(kind) if flat.dtype == np.uint64 else flat.astype(kind)))

                rows = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(rows),
                        batch["text_key"].take(rows),
                        pa.array(in_group[which]),
                        ragged(spots, kind=np.int32),
                        ragged(high),
                        ragged(low),
                    ],
                    window_names,
                )

    found = work.stored(
        texts.mapInArrow(
            suspected,
            f"doc_id {kind}, text_key long, in_group boolean, pos array<int>, high array<long>, low array<long>",
        ),
        "suspected",
    )
    firsts_only = found.filter("not in_group").unionByName(
        found.filter("in_group").join(copies, ["doc_id", "text_key"], "left_anti")
    )
    windows = firsts_only.select("doc_id", "text_key", F.explode(F.arrays_zip("pos", "high", "low")).alias("w")).select(
        "doc_id", "text_key", "w.pos", "w.high", "w.low"
    )
    first_seen = work.stored(
        windows.groupBy("high", "low")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("high", "low", "first"),
        "first_seen",
    )
    marks = work.stored(
        windows.join(first_seen, ["high", "low"])
        .filter("doc_id > first")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("starts"))
        .unionByName(copies.withColumn("starts", F.array(F.lit(ALL)))),
        "marks",
    )
    work.drop("groups", "suspected", "first_seen")
    id_cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - id_bits)
    marked = spark.sparkContext.broadcast(bitmap(marks.select(id_cell), id_bits))
    results = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    schema = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def judged(words: list[bytes], kept: list[bytes]) -> tuple:
        body = b" ".join(kept)
        return len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), body.decode()

    def columns(rows: list[tuple]) -> list[pa.Array]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return [pa.array([r[c] for r in rows], kinds[c]) for c in range(len(results))]

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of the documents that are certainly not marked; the others keep their text."""
        for batch in batches:
            wait = bit_set(marked.value, batch["cell"].to_numpy())
            rows, texts = [], []
            for text, later in zip(batch["text"].to_pylist(), wait.tolist(), strict=True):
                words = [] if later else words_of(text)
                rows.append((None,) * 4 if later else judged(words, words))
                texts.append(text if later else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(texts, pa.string()), *columns(rows)],
                ["doc_id", "text_key", "text", *results],
            )

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of the documents that kept their text, from the starts of their marked windows."""
        for batch in batches:
            rows = list(zip(*(batch[c].to_pylist() for c in results), strict=True))
            for i, row in enumerate(rows):
                if row[0] is not None:
                    continue
                words = words_of(batch["text"][i].as_py())
                starts = np.asarray(batch["starts"][i].as_py() or [], np.int64)
                if len(starts) and starts[0] == ALL:
                    covered = np.full(len(words), len(words) >= settings.window)
                else:
                    opened = np.bincount(starts, minlength=len(words) + 1)
                    closed = np.bincount(starts + settings.window, minlength=len(words) + 1)
                    covered = np.cumsum(opened - closed)[: len(words)] > 0
                rows[i] = judged(words, [w for w, c in zip(words, covered.tolist(), strict=True) if not c])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns(rows)], ["doc_id", *results])

    return (
        keyed.select("doc_id", "text", "text_key", F.coalesce(id_cell, F.lit(0)).alias("cell"))
        .mapInArrow(untouched, f"doc_id {kind}, text_key long, text string, {schema}")
        .join(marks, ["doc_id", "text_key"], "left")
        .mapInArrow(reduced, f"doc_id {kind}, {schema}")
    )
