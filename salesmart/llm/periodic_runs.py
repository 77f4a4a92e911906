"""Periodic runs of words, found through a run-length grammar of the text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.tables import ship_package
from salesmart.llm.words import words_of

# Words whose grammar is built at once; a longer text is alone in its group.
GROUP_WORDS = 150_000
# Pairs of places whose extensions are looked up at once.
LOOKUPS = 100_000
# Spreads symbols over the two classes of a pair round.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class RunSettings(NamedTuple):
    """least: words of the shortest run. A run is also twice its period long."""

    least: int = 12


class Level(NamedTuple):
    """One round of compression. ``symbols`` before it; ``phrase``: the place of each
    after it; ``starts``: where each phrase starts, and the end; ``right``: for a pair
    round, which symbols are of the class that ends a pair, else None."""

    symbols: np.ndarray
    phrase: np.ndarray
    starts: np.ndarray
    right: np.ndarray | None


class Grammar:
    """A run-length grammar over texts, by recompression.

    Rounds alternate. A block round replaces each stretch of one symbol by a symbol
    for (symbol, length). A pair round splits the symbols into two classes, left and
    right, and replaces each left symbol with a right one after it by a symbol for
    the pair. Equal phrases get equal symbols, all others different ones: names come
    from sorting, not from hashes. Rounds go on until each text is one symbol. The
    classes come from the bits of a product, so a text is parsed the same wherever it
    stands but for its ends; that is what the extensions rest on.

    ``symbols`` holds the texts with a mark before and after each, and every mark
    occurs once. Marks are the numbers below ``marks``; they are never compressed.
    """

    def __init__(self, symbols: np.ndarray, marks: int):
        self.levels: list[Level] = []
        fresh = int(symbols.max()) + 1
        turn = 0
        while len(symbols) > 2 * marks - 1:
            symbols, fresh = self._blocks(symbols, fresh)
            symbols, fresh = self._pairs(symbols, fresh, marks, turn)
            turn += 1
        self.top = symbols

    def _add(self, symbols: np.ndarray, first: np.ndarray, right: np.ndarray | None) -> np.ndarray:
        starts = np.flatnonzero(first)
        self.levels.append(Level(symbols, np.cumsum(first) - 1, np.append(starts, len(symbols)), right))
        return starts

    def _blocks(self, symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        first = np.ones(len(symbols), bool)
        np.not_equal(symbols[1:], symbols[:-1], out=first[1:])
        if first.all():
            return symbols, fresh
        starts = self._add(symbols, first, None)
        lengths = np.diff(np.append(starts, len(symbols)))
        after = symbols[starts]
        several = np.flatnonzero(lengths > 1)
        distinct, names = np.unique(after[several] * (lengths.max() + 1) + lengths[several], return_inverse=True)
        after[several] = fresh + names
        return after, fresh + len(distinct)

    def _pairs(self, symbols: np.ndarray, fresh: int, marks: int, turn: int) -> tuple[np.ndarray, int]:
        bits = (symbols.astype(np.uint64) + np.uint64(2 * turn + 1)) * SPREAD
        right = ((bits ^ (bits >> np.uint64(29))) * SPREAD >> np.uint64(63)).astype(bool)
        text = symbols >= marks
        inner = text[:-1] & text[1:]
        pair, other = ~right[:-1] & right[1:] & inner, right[:-1] & ~right[1:] & inner
        if np.count_nonzero(other) > np.count_nonzero(pair):
            pair, right = other, ~right
        at = np.flatnonzero(pair)
        if not len(at):
            return symbols, fresh
        first = np.ones(len(symbols), bool)
        first[at + 1] = False
        starts = self._add(symbols, first, right)
        distinct, names = np.unique(symbols[at] * fresh + symbols[at + 1], return_inverse=True)
        after = symbols[starts]
        after[self.levels[-1].phrase[at]] = fresh + names
        return after, fresh + len(distinct)

    def extension(self, one: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
        """How many symbols from ``one`` on equal those from ``other`` on: to the right
        with ``step`` 1, to the left with -1.

        Going up, both places take whole phrases: where the symbols agree, the places
        move past what their phrases have left and on to the next round. Where they do
        not, the places go down again, each time into the first children, of which at
        most one phrase's worth agrees.
        """
        a, b = one.copy(), other.copy()
        differ: list[np.ndarray] = []
        alive = np.arange(len(a))
        for level in self.levels:
            x, y = a[alive], b[alive]
            same = level.symbols[x] == level.symbols[y]
            differ.append(alive[~same])
            alive, x, y = alive[same], x[same], y[same]
            if level.right is None:
                left_x, left_y = self._left(level, x, step), self._left(level, y, step)
                even = left_x == left_y
                short = np.minimum(left_x, left_y)[~even]
                a[alive[~even]] += step * short
                b[alive[~even]] += step * short
                differ[-1] = np.concatenate([differ[-1], alive[~even]])
                alive, x, y = alive[even], x[even], y[even]
                a[alive], b[alive] = level.phrase[x] + step, level.phrase[y] + step
            else:
                # The class that ends a phrase in this direction leaves nothing of it.
                move = step * (level.right[x] == (step > 0))
                a[alive], b[alive] = level.phrase[x + move], level.phrase[y + move]
        while len(alive):  # one symbol a text is left, so this is the mark between two
            alive = alive[self.top[a[alive]] == self.top[b[alive]]]
            a[alive] += step
            b[alive] += step
        down = np.setdiff1d(np.arange(len(a)), np.concatenate([*differ, np.zeros(0, np.int64)]))
        for level, here in zip(reversed(self.levels), reversed(differ), strict=True):
            x, y = self._child(level, a[down], step), self._child(level, b[down], step)
            same = level.symbols[x] == level.symbols[y]
            if level.right is None:
                move = step * np.where(same, np.minimum(self._left(level, x, step), self._left(level, y, step)), 0)
            else:
                move = step * same
            a[down], b[down] = x + move, y + move
            down = np.concatenate([down, here])
        return np.abs(a - one)

    @staticmethod
    def _left(level: Level, at: np.ndarray, step: int) -> np.ndarray:
        """Symbols of the phrase from ``at`` on in the direction, itself included."""
        phrase = level.phrase[at]
        return level.starts[phrase + 1] - at if step > 0 else at - level.starts[phrase] + 1

    @staticmethod
    def _child(level: Level, phrase: np.ndarray, step: int) -> np.ndarray:
        return level.starts[phrase] if step > 0 else level.starts[phrase + 1] - 1


def candidates(symbols: np.ndarray, ends: list[tuple[int, int]], least: int) -> Iterator[tuple[np.ndarray, int]]:
    """Places i on the grid of each period q where the symbols i and i + q agree, and so
    do those before or after them.

    Every run of period q holds two neighbours of the grid of step q. ``ends`` are
    (words, end in ``symbols``) of the texts, longest first: only texts of twice the
    period can hold a run of it.
    """
    texts = len(ends)
    for period in range(1, ends[0][0] // 2 + 1):
        while texts and ends[texts - 1][0] < max(least, 2 * period):
            texts -= 1
        if not texts:
            return
        end = ends[texts - 1][1]
        at = np.flatnonzero(symbols[: end - period : period] == symbols[period:end:period]) * period
        if len(at):
            yield at[(symbols[at + 1] == symbols[at + 1 + period]) | (symbols[at - 1] == symbols[at - 1 + period])], period


def group_runs(texts: list[np.ndarray], least: int) -> np.ndarray:
    """All runs of texts given as numbers of their words: rows (text, start, length, period)
    by text, start and period. ``least`` is at least 4."""
    order = sorted((i for i in range(len(texts)) if len(texts[i]) >= least), key=lambda i: -len(texts[i]))
    none = np.zeros((0, 4), np.int64)
    if not order:
        return none
    marks = len(order) + 1
    parts, ends, begins = [np.zeros(1, np.int64)], [], []
    at = 1
    for mark, i in enumerate(order, 1):
        parts += [texts[i] + marks, np.full(1, mark)]
        begins.append(at)
        at += len(texts[i]) + 1
        ends.append((len(texts[i]), at - 1))
    symbols = np.concatenate(parts)
    grammar = Grammar(symbols, marks)
    found: list[np.ndarray] = []

    def look_up(places: list[np.ndarray], periods: list[int]) -> None:
        sizes = [len(p) for p in places]
        at, period = np.concatenate(places), np.repeat(periods, sizes)
        for first in range(0, len(at), LOOKUPS):
            i, q = at[first : first + LOOKUPS], period[first : first + LOOKUPS]
            after = grammar.extension(i, i + q, 1)
            before = grammar.extension(i - 1, i + q - 1, -1)
            good = before + after >= np.maximum(q, least - q)
            rows = np.stack([(i - before)[good], (i + q + after)[good], q[good]], axis=1)
            found.append(np.unique(rows, axis=0))

    places: list[np.ndarray] = []
    periods: list[int] = []
    waiting = 0
    for at, period in candidates(symbols, ends, least):
        places.append(at)
        periods.append(period)
        waiting += len(at)
        if waiting >= LOOKUPS:
            look_up(places, periods)
            places, periods, waiting = [], [], 0
    if waiting:
        look_up(places, periods)
    if not found:
        return none
    # A stretch found with several periods is a run of the smallest one.
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    begins = np.array(begins)
    which = np.searchsorted(begins, runs[:, 0], "right") - 1
    rows = np.stack([np.array(order)[which], runs[:, 0] - begins[which], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def judged(texts: list[list[bytes]], least: int) -> list[tuple[np.ndarray, bytes]]:
    """For each text, given as words, its runs (start, length, period) and the text without repeats."""
    numbers = Numbers()
    coded = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    runs = group_runs(coded, least)
    bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    results = []
    for i, words in enumerate(texts):
        own = runs[bounds[i] : bounds[i + 1], 1:]
        if len(own):
            opened = np.bincount(own[:, 0] + own[:, 2], minlength=len(words) + 1)
            closed = np.bincount(own[:, 0] + own[:, 1], minlength=len(words) + 1)
            kept = np.cumsum(opened - closed)[: len(words)] == 0
            words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
        results.append((own, b" ".join(words)))
    return results


def periodic_runs(documents: DataFrame, settings: RunSettings = RunSettings()) -> DataFrame:
    r"""One row per row of ``documents`` (``doc_id``, ``text``) with all its periodic runs.

    Words are ``[^\x20\x09-\x0D]+``, numbered from 0. A run is a stretch of words with
    smallest period q (words q apart are the same) of at least ``least`` and 2 q words,
    which no neighbouring word extends. Every run is found: texts are compressed into a
    grammar (``Grammar``), and on the grid of each period the places where neighbours
    agree are extended both ways as far as the period goes, through the grammar. Of n
    words that takes n log n comparisons and at most as many extensions, of log n steps.

    Texts are independent, so nothing is shuffled; a worker holds the grammar of
    ``GROUP_WORDS`` words or of one text. A null or empty text has no words and no
    runs. Rows are judged each for itself, so repeated rows, ids that repeat or are
    null need no care. Other columns are ignored.

    Returns ``doc_id, n_words, runs`` (``start, length, period``, by start, then
    period) and ``collapsed_text``: the words that no run covers after its first q
    words, joined by one space.
    """
    ship_package(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def result(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = judged(texts, settings.least)
        ends = np.cumsum([0, *(len(runs) for runs, _ in found)])
        flat = np.concatenate([runs for runs, _ in found])
        structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(run))
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(words) for words in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                pa.array([body.decode() for _, body in found], pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed_text"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[list[bytes]] = []
            first = total = 0
            for i, text in enumerate(batch["text"]):
                texts.append(words_of(text.as_py()))
                total += len(texts[-1])
                if total >= GROUP_WORDS or i == batch.num_rows - 1:
                    yield result(batch["doc_id"].slice(first, len(texts)), texts)
                    texts, first, total = [], i + 1, 0

    return documents.select("doc_id", "text").mapInArrow(
        search,
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string",
    )
