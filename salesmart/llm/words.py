"""Words of texts as arrays of hashes, and hashes of runs of words."""

from __future__ import annotations

import functools
import hashlib

import numpy as np

# Distinct words a worker remembers; beyond that it starts anew.
REMEMBERED = 300_000
# Base of the rolling hash: odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """128-bit hashes of words in two columns; each distinct word is hashed once."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros((1 << 14, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        if place == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[place] = np.frombuffer(hashlib.blake2b(word, digest_size=16).digest(), "<u8")
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[places]


@functools.lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """The worker's own."""
    return WordHashes()


def words_of(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+``: what splitting bytes at white space gives."""
    return (text or "").encode().split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


@functools.lru_cache(maxsize=64)
def _powers(base: int, bits: int) -> np.ndarray:
    steps = np.full(1 << bits, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive hashes that depends on their order.

    The sum of h[i + j] / BASE**j modulo 2**64, from one prefix sum.
    """
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    bits = max(10, n.bit_length())
    down, up = _powers(pow(BASE, -1, 1 << 64), bits), _powers(BASE, bits)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[:n], dtype=np.uint64)])
    return mixed((upto[size:] - upto[:-size]) * up[: n - size + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, by doubling."""
    have = 1
    least = values
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
