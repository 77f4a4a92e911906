"""Best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace, ship_package
from salesmart.llm.token_count import byte_symbols

# Fixed value: the pattern of byte-level files that splits a text before the merges.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Items one task packs, and the share of a round's items that must vanish for another round.
GROUP_ITEMS = 20_000
PROGRESS = 0.1


@functools.lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> tiktoken.Encoding:
    """The file's vocabulary as merge ranks; special strings count as their tokens."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    vocabulary = described["model"]["vocab"]
    made = [vocabulary[a + b] for a, b in described["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    byte = {s: b for b, s in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut_points(length: int, limit: int) -> np.ndarray:
    """Starts of a document's pieces: of ``limit`` tokens each, but the first may be shorter."""
    return np.concatenate([[0], np.arange(length % limit or limit, length, limit)]).astype(np.int64)


def tokenised_pieces(documents: DataFrame, path: str, limit: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document: ``doc_id, piece, start, length, ids_crc32``.

    A document is its tokens and then ``end_id``; a null text has only that. Documents
    longer than ``limit`` are cut. ``with_ids`` adds the tokens themselves.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                some = batch.slice(first, 500)
                which, piece, start, length, crc, tokens = [], [], [], [], [], []
                for i, text in enumerate(some["text"].to_pylist()):
                    ids = np.append(tokenizer.encode_to_numpy(text or "", allowed_special="all"), end_id).astype("<u4")
                    starts = cut_points(len(ids), limit)
                    parts = np.split(ids, starts[1:])
                    which += [i] * len(parts)
                    piece += range(len(parts))
                    start += starts.tolist()
                    length += map(len, parts)
                    crc += [zlib.crc32(p.tobytes()) for p in parts]
                    tokens += parts if with_ids else ()
                columns = [
                    some["doc_id"].take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int64) for p in tokens], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    ship_package(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, each into the fullest bin it fits.

    Open bins are kept by free space; a number with a bit for each free space that
    occurs gives the smallest that suffices.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_free: list[list[int]] = [[] for _ in range(limit + 1)]
    spaces, opened = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = by_free[free].pop()
            if not by_free[free]:
                spaces ^= 1 << free
        else:
            free, number = limit, opened
            opened += 1
        bins[i], offsets[i] = number, limit - free
        if free > size:
            by_free[free - size].append(number)
            spaces |= 1 << (free - size)
    return bins, offsets


def packer(limit: int, slack: int, number: int, last: bool):
    """Packs the items of a group in round ``number``; in the last all sequences are done."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_bin", "offset"], kind="stable", ignore_index=True)
        _, item = np.unique(group["_bin"].to_numpy(), return_inverse=True)
        sizes = np.bincount(item, weights=group["length"].to_numpy()).astype(np.int64)
        bins, offsets = best_fit(sizes, limit)
        filled = np.bincount(bins, weights=sizes)
        group["offset"] += offsets[item]
        # Round, group and place: unique among all rounds.
        group["_bin"] = (number + 1 << 52) + (int(key[0]) << 28) + bins[item]
        group["_full"] = last | (filled[bins[item]] >= limit - slack)
        return group.drop(columns="_group")

    return pack


def packed(pieces: DataFrame, limit: int, slack: int = 8, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``pieces`` with the sequence and the offset of each.

    A piece of ``limit`` tokens is a sequence. The others are dealt at random into
    groups that a task packs best-fit; sequences with at most ``slack`` free places
    are done, the rest go on as items into fewer, newly dealt groups, until one
    group is left or a round no longer lessens the items by a tenth. A task holds
    ``group_items`` items, at most about as many rows again per member.

    Expects ``length`` from 1 to ``limit``; other columns pass through. Adds
    ``sequence_id`` and ``offset``, gapless from 0 in every sequence.
    """
    work = Workspace(pieces.sparkSession, "packing")
    columns = pieces.columns
    own = work.stored(pieces.withColumn("_bin", F.monotonically_increasing_id()), "pieces")
    done = [
        own.filter(F.col("length") >= limit).select(
            *columns, (-1 - F.col("_bin")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
        )
    ]
    items = own.filter(F.col("length") < limit).select(*columns, "_bin", F.lit(0).cast("long").alias("offset"))
    n, number = items.count(), 0
    schema = items.withColumn("_full", F.lit(True)).schema
    while n:
        groups = max(1, -(-n // group_items))
        last = groups == 1
        dealt = items.withColumn("_group", F.pmod(F.xxhash64(F.lit(number), "_bin"), F.lit(groups)))
        out = work.stored(dealt.groupBy("_group").applyInPandas(packer(limit, slack, number, last), schema), f"round{number}")
        left = 0 if last else out.filter("not _full").agg(F.count_distinct("_bin")).first()[0]
        stuck = left > (1 - PROGRESS) * n
        emitted = out if last or stuck else out.filter("_full")
        done.append(emitted.select(*columns, F.col("_bin").alias("sequence_id"), "offset"))
        if last or stuck:
            break
        items, n, number = out.filter("not _full").drop("_full"), left, number + 1
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def packed_sequences(documents: DataFrame, path: str, limit: int = 1024, end_id: int = 2) -> DataFrame:
    """Documents (``doc_id``, ``text``) as pieces of at most ``limit`` tokens in few sequences.

    Every row gives its pieces, also rows that repeat. Returns ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset``.
    """
    return packed(tokenised_pieces(documents, path, limit, end_id), limit)
