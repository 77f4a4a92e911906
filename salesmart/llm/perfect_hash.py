"""Minimal perfect hashes: distinct keys to the numbers from 0 to their count, without gaps."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np

from salesmart.llm.words import mixed

# Places a key in a level, and levels. What no level could place is searched.
ROOM, LEVELS = 2, 32
STEP = 0x9E3779B97F4A7C15


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each key."""
    joined = b"".join(hashlib.blake2b(key, digest_size=16).digest() for key in keys)
    return np.frombuffer(joined, "<u8").reshape(-1, 2)


def places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(level * STEP & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


class Levels(NamedTuple):
    """sizes: places of each level. bits: which are taken, packed, level after level."""

    sizes: list[int]
    bits: bytes


def built(hashes: np.ndarray) -> tuple[Levels, np.ndarray]:
    """The levels for distinct keys, given by a hash each, and the number of each key.

    On each level a key that is alone in its place stays there; the others go on. A
    key's number is that of its place among the taken ones. Keys that share a hash,
    or that no level places, come last, in their order.
    """
    numbers = np.full(len(hashes), -1, np.int64)
    waiting = np.arange(len(hashes))
    sizes, parts, done = [], [], 0
    while len(waiting) and len(sizes) < LEVELS:
        size = -(-max(8, ROOM * len(waiting)) // 8) * 8
        at = places(hashes[waiting], len(sizes), size)
        taken = np.bincount(at, minlength=size) == 1
        alone = taken[at]
        numbers[waiting[alone]] = done + np.cumsum(taken)[at[alone]] - 1
        done += int(np.count_nonzero(taken))
        sizes.append(size)
        parts.append(np.packbits(taken))
        waiting = waiting[~alone]
    numbers[waiting] = done + np.arange(len(waiting))
    return Levels(sizes, b"".join(p.tobytes() for p in parts)), numbers


class PerfectHash:
    """Looks keys up, each against the key that is stored under its number.

    ``text`` holds the keys by number, with a space after each but the last; no key
    has a space.
    """

    def __init__(self, levels: Levels, text: bytes):
        self.text = text
        self.ends = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 32), len(text))
        self.levels = []
        begin = self.placed = 0
        for size in levels.sizes:
            taken = np.unpackbits(np.frombuffer(levels.bits[begin : begin + size // 8], np.uint8))
            ranks = self.placed + np.cumsum(taken, dtype=np.int32) - 1
            self.levels.append((size, taken.astype(bool), ranks))
            begin += size // 8
            self.placed += int(np.count_nonzero(taken))
        self.rest = {self.key(i): i for i in range(self.placed, len(self.ends))}

    def __len__(self) -> int:
        return len(self.ends)

    def key(self, number: int) -> bytes:
        return self.text[self.ends[number - 1] + 1 if number else 0 : self.ends[number]]

    def numbers(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those that are not stored."""
        found = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, (size, taken, ranks) in enumerate(self.levels):
            at = places(hashes[waiting], level, size)
            here = taken[at]
            found[waiting[here]] = ranks[at[here]]
            waiting = waiting[~here]
        for i in np.flatnonzero(found >= 0).tolist():
            if self.key(found[i]) != keys[i]:
                found[i] = -1
        if self.rest:
            for i in np.flatnonzero(found < 0).tolist():
                found[i] = self.rest.get(keys[i], -1)
        return found
