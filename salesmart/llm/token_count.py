"""Token counts by merging byte pairs in ragged arrays, lowest ranks first."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import ship_package

# Distinct chunks whose counts a worker remembers, of at most so many characters;
# beyond that number it starts anew.
REMEMBERED, LONG = 300_000, 64
# From here on the library knows unassigned characters as other kinds than ``regex`` does.
RARE = "\U00030000"
# Distinct pre-tokens merged at once.
BATCH = 50_000
NO_RANK = np.int32(2**31 - 1)
NO_PAIR = np.int64(-1)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where
    it is printable in Latin-1, else the next free one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class PairTable:
    """Ranks of symbol pairs, looked up for whole arrays: an open-addressed hash table."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, results: np.ndarray):
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, NO_PAIR)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        self.results = results.astype(np.int32)
        left = np.arange(len(pairs))
        self.probes = 0
        while len(left):  # those that lose a free slot try the next one
            slot = (self._slot(pairs[left]) + self.probes) & ((1 << self.bits) - 1)
            free = self.keys[slot] == NO_PAIR
            self.keys[slot[free]] = pairs[left[free]]
            won = self.keys[slot] == pairs[left]
            self.ranks[slot[won]] = ranks[left[won]]
            left = left[~won]
            self.probes += 1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, pairs: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where it is no merge."""
        found = np.full(len(pairs), NO_RANK, np.int32)
        first, todo = self._slot(pairs), np.arange(len(pairs))
        for probe in range(self.probes):
            slot = (first[todo] + probe) & ((1 << self.bits) - 1)
            keys = self.keys[slot]
            hit = keys == pairs[todo]
            found[todo[hit]] = self.ranks[slot[hit]]
            todo = todo[~hit & (keys != NO_PAIR)]
            if not len(todo):
                break
        return found


class WordTokenizer:
    """Counts the tokens of a byte-level BPE file with word ends, lower case, white space dropped."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, vocabulary = described["model"], described["model"]["vocab"]
        # The library's own normalizer, so that letters and compositions are its.
        self.library = Tokenizer.from_file(path)
        self.normalizer = self.library.normalizer
        split = described["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(split["pattern"]["Regex"])
        special = [t["content"] for t in described["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)))
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int32)
        self.last = np.array([vocabulary[s + model["end_of_word_suffix"]] for s in symbols], np.int32)
        self.size = max(vocabulary.values()) + 1
        merges = model["merges"]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        results = np.array([vocabulary[a + b] for a, b in merges])
        self.pairs = PairTable(left * self.size + right, np.arange(len(merges), dtype=np.int32), results)
        self.counts: dict[str, int] = {}

    def merged_lengths(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token when no merge applies any more.

        All words lie in one array. Each round looks up the ranks of all adjacent
        pairs, takes each word's lowest and merges it wherever it occurs in the
        word; of overlapping places the first, third and so on. Words without a
        pair to merge leave the arrays.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths)
        tail = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
        ids[ends - 1] = self.last[tail]
        word = np.repeat(np.arange(len(words)), lengths)
        while len(ids):
            ranks = np.full(len(ids), NO_RANK, np.int32)
            joined = np.flatnonzero(word[1:] == word[:-1])
            ranks[joined] = self.pairs.lookup(ids[joined].astype(np.int64) * self.size + ids[joined + 1])
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(ranks, starts)
            spans = np.diff(np.append(starts, len(ids)))
            merge = (ranks == np.repeat(lowest, spans)) & (ranks != NO_RANK)
            at = np.flatnonzero(merge)
            # Overlapping places of one pair: every second one of a run.
            new_run = np.concatenate([[True], np.diff(at) != 1])
            run_start = at[np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))] if len(at) else at
            at = at[(at - run_start) % 2 == 0]
            ids[at] = self.pairs.results[ranks[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            lengths -= np.bincount(word[at], minlength=len(words))
            keep &= np.repeat(lowest != NO_RANK, spans)
            ids, word = ids[keep], word[keep]
        return lengths

    def learnt(self, chunks: Iterable[str]) -> dict[str, int]:
        """The tokens of texts without white space. Those with characters from ``RARE`` on,
        next to none, are counted by the library."""
        chunks, counts = list(chunks), {}
        for start in range(0, len(chunks), BATCH):
            some = chunks[start : start + BATCH]
            words, owner = [], []
            extra = np.zeros(len(some), np.int64)
            for i, chunk in enumerate(some):
                if max(chunk) >= RARE:
                    extra[i] = len(self.library.encode(chunk, add_special_tokens=False).ids)
                    continue
                parts = (chunk,)
                if "<|" in chunk:
                    parts = self.special.split(chunk)
                    extra[i] = len(parts) - 1
                for part in parts:
                    found = self.pieces.findall(self.normalizer.normalize_str(part) if part else "")
                    words.extend(found)
                    owner.extend([i] * len(found))
            if words:
                distinct = {w: n for n, w in enumerate(dict.fromkeys(words))}
                lengths = self.merged_lengths([w.encode() for w in distinct])
                which = np.fromiter((distinct[w] for w in words), np.int64, len(words))
                extra += np.bincount(owner, weights=lengths[which], minlength=len(some)).astype(np.int64)
            counts.update(zip(some, extra.tolist(), strict=True))
        return counts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. No piece crosses white space, so texts are counted by
        the chunks between it, each distinct one once. Long chunks are not remembered."""
        split = [chunks_of(t) for t in texts]
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        fresh = self.learnt(set().union(*split).difference(self.counts))
        self.counts.update(fresh)
        totals = [sum(map(self.counts.__getitem__, chunks)) for chunks in split]
        for chunk in fresh:
            if len(chunk) > LONG:
                del self.counts[chunk]
        return totals


WHITE = regex.compile(r"[\s--[\x1c-\x1f]]+", regex.V1)


def chunks_of(text: str) -> list[str]:
    """The runs between white space; U+001C to U+001F are none to the tokenizer."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in WHITE.split(text) if c]
    return text.split()


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_counts(documents: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``) with the tokens of its whole text.

    ``path`` names a byte-level BPE file with word ends that every executor can
    read. Counts are those of the library without added tokens; special strings in
    a text count as their token. A null or empty text has none. Other columns are
    ignored. Returns ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit``).
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                numbers = tokenizer.count([t or "" for t in some["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], some["n_bytes"], pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    ship_package(documents.sparkSession)
    sized = documents.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return sized.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
