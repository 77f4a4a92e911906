"""Approximate nearest neighbours along shifted Hilbert curves."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace


class CurveSettings(NamedTuple):
    """curves: orderings, each over ``dims`` random projections on a grid of
    2**bits cells a side, shifted at random.
    windows: key ranges a curve is cut into; a query looks into its own and the
    next one on either side. least_rows: vectors a range holds at least, so that
    there are fewer ranges of few vectors. window_rows: rows of a window that one task compares;
    larger windows are split into as many parts as it takes.
    sample: vectors of a width from which its ranges are set, about, at most."""

    curves: int = 16
    dims: int = 12
    bits: int = 4
    windows: int = 40
    least_rows: int = 256
    window_rows: int = 1024
    sample: int = 20_000
    seed: int = 17


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells, as one integer.

    The usual way by Gray codes: per bit from the highest, exchange or invert the
    lower bits of the axes, then undo the Gray code and interleave.
    """
    axes = [column.astype(np.int64) for column in cells.T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(axes)):
            high = (axes[i] >> bit) & 1 == 1
            change = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0]) ^ change
            axes[i] = axes[i] ^ change if i else axes[0]
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flips = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(flips)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flips) >> bit) & 1)
    return key


class Curves:
    """Projections and shifts of all curves for vectors of one width."""

    def __init__(self, width: int, settings: CurveSettings):
        self.settings = settings
        self.dims = min(settings.dims, width, 62 // settings.bits)
        chance = np.random.default_rng(settings.seed)
        turned = [np.linalg.qr(chance.normal(size=(width, width)))[0][:, : self.dims] for _ in range(settings.curves)]
        self.axes = np.hstack(turned)
        self.shift = chance.random(self.axes.shape[1])
        # Components of a unit vector along a random axis lie within four deviations.
        self.reach = min(1.0, 4 / np.sqrt(width))

    def keys(self, units: np.ndarray) -> np.ndarray:
        """Key of each vector (row) on each curve (column)."""
        side = 1 << self.settings.bits
        # The grid spans twice the reach; the shift moves the vectors within it.
        scaled = (np.clip(units @ self.axes, -self.reach, self.reach) / self.reach + 1) / 2
        cells = np.minimum(((scaled + self.shift) / 2 * side).astype(np.int64), side - 1)
        parts = np.split(cells, self.settings.curves, axis=1)
        return np.column_stack([hilbert_keys(part, self.settings.bits) for part in parts])


class Ranges(NamedTuple):
    """How the vectors of one width are dealt: ``cuts`` between the windows of each
    curve, and parts of a window. A single window needs no curve."""

    windows: int
    parts: int
    curves: Curves | None = None
    cuts: np.ndarray | None = None

    def windows_of(self, vectors: np.ndarray) -> np.ndarray:
        if self.curves is None:
            return np.zeros((len(vectors), 1), np.int64)
        found = self.curves.keys(units_of(vectors))
        return np.column_stack([np.searchsorted(self.cuts[:, c], found[:, c], side="right") for c in range(found.shape[1])])


def usable(vector: str | Column) -> Column:
    """Whether a vector takes part: no null, all components finite, not zero throughout."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, also for very large and very small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def ranges(index: DataFrame, settings: CurveSettings) -> dict[int, Ranges]:
    """For each width of the vectors in ``index``. The driver sees a row per width, and a
    sample of the vectors of those widths that have enough for two windows."""
    sizes = {r["width"]: r["n"] for r in index.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).collect()}
    windows = {width: max(1, min(settings.windows, n // settings.least_rows)) for width, n in sizes.items()}
    shares = [(width, min(1.0, settings.sample / n)) for width, n in sizes.items() if windows[width] > 1]
    sampled: dict[int, list] = {}
    if shares:
        share = F.broadcast(index.sparkSession.createDataFrame(shares, "width int, share double"))
        chance = F.pmod(F.xxhash64(F.lit(settings.seed), "vector"), F.lit(1 << 30)) / F.lit(1 << 30)
        chosen = index.join(share, F.size("vector") == F.col("width")).filter(chance < F.col("share"))
        for vector in chosen.select("vector").toPandas()["vector"]:
            sampled.setdefault(len(vector), []).append(vector)
    found = {}
    for width, n in sizes.items():
        count = min(windows[width], max(1, len(sampled.get(width, ()))))
        parts = max(1, round(n / count / settings.window_rows))
        found[width] = Ranges(count, parts)
        if count > 1:
            curves = Curves(width, settings)
            keys = np.sort(curves.keys(units_of(np.stack(sampled[width]).astype(np.float64))), axis=0)
            found[width] = Ranges(count, parts, curves, keys[np.arange(1, count) * len(keys) // count])
    return found


def closest(near: np.ndarray, members: list[list[int]], query_id: int, k: int, score: Callable[[int], float]) -> list[tuple[float, int]]:
    """``(-score, id)`` of the ``k`` best ids other than ``query_id``, each once with its best score.

    ``near`` ranks the vectors, ``members`` are their ids. As many vectors are looked
    at as it takes to name ``k`` ids: ids may hold several vectors, the query too.
    """
    enough = k + 1
    while True:
        enough = min(enough, len(near))
        best: dict[int, float] = {}
        for i in np.flatnonzero(near >= np.partition(near, -enough)[-enough]):
            others = [other for other in members[i] if other != query_id]
            value = score(i) if others else 0.0
            for other in others:
                best[other] = max(value, best.get(other, value))
        if len(best) >= k or enough == len(near):
            return sorted((-value, other) for other, value in best.items())[:k]
        enough *= 2


def nearest(
    embeddings: DataFrame,
    queries: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    settings: CurveSettings = CurveSettings(),
) -> DataFrame:
    """The ``k`` nearest by cosine that the curves find for each row that ``queries`` marks.

    Equal vectors are indexed once, with their ``k + 1`` smallest distinct ids, which is
    all that an answer can name of them; so crowds of copies and repeated rows take no
    room on the curves and ties come out by id. Vectors are compared with those of the
    same width, and each width has its own curves. Each curve is cut into key ranges of
    about equal size, set from a bounded sample; every vector lies in one window of
    every curve, and a query meets the windows around it, part by part. Scores are in double
    precision on the original vectors; the best of all windows and curves are kept.
    A query that finds fewer than ``k`` there, as one id's vectors may fill its
    windows, meets all windows of one curve.

    Vectors that are null, zero, or hold a null or non-finite component take no
    part, nor do rows without an id. An id whose rows repeat is named once, with its best score. Returns
    ``query_id, rank, vec_id, score``.
    """
    work = Workspace(embeddings.sparkSession, "neighbours")
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("is_query")
    ).filter(F.col("vec_id").isNotNull() & usable("vector"))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    lists = (
        rows.select("vector", "vec_id")
        .distinct()
        .withColumn("nth", F.row_number().over(smallest))
        .filter(F.col("nth") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    index = work.stored(lists.withColumn("vec", F.monotonically_increasing_id()), "index")
    asked = work.stored(rows.filter("is_query").select("vec_id", "vector").distinct(), "asked")
    schema = "query_id long, rank int, vec_id long, score double"
    answer = ["query_id", "rank", "vec_id", "score"]
    dealt = ranges(index, settings)
    if not dealt:
        return embeddings.sparkSession.createDataFrame([], schema)

    def placed(batches: Iterator[pa.RecordBatch], reach: int | None, over: int) -> Iterator[pa.RecordBatch]:
        """Each vector once per window within ``reach`` of its own (of all, if None), on the first ``over`` curves."""
        for batch in batches:
            widths = pc.list_value_length(batch["vector"]).to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                windows, parts, *_ = its = dealt[width]
                alike = batch.filter(pa.array(widths == width))
                own = its.windows_of(matrix(alike["vector"]))
                far = windows - 1 if reach is None else min(reach, windows - 1)
                for step in range(-far, far + 1):
                    for c in range(min(over, own.shape[1])):
                        at = own[:, c] + step
                        inside = pa.array(np.flatnonzero((at >= 0) & (at < windows)))
                        some = pa.RecordBatch.from_arrays([x.take(inside) for x in alike.columns], alike.schema.names)
                        for name, value in (("width", width), ("curve", c), ("parts", parts)):
                            some = some.append_column(name, pa.array(np.full(len(inside), value, np.int32)))
                        yield some.append_column("window", pa.array(at[inside.to_numpy()], pa.int32()))

    kind = index.schema["vector"].dataType.simpleString()
    place = "width int, curve int, parts int, window int"
    part = F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int").alias("part")
    no_query, no_ids = F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<long>").alias("ids")

    def met(some: DataFrame, reach: int | None, over: int) -> DataFrame:
        """``query_id, vec_id, score``: for ``some`` of those asked, the best of each window within reach."""
        held = index.mapInArrow(lambda b: placed(b, 0, over), f"vector {kind}, ids array<long>, vec long, {place}")
        held = held.select("width", "curve", "window", part, no_query, "ids", "vector")
        sent = some.mapInArrow(lambda b: placed(b, reach, over), f"vec_id long, vector {kind}, {place}")
        each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        sent = sent.select("width", "curve", "window", each, F.col("vec_id").alias("query_id"), no_ids, "vector")
        found = held.unionByName(sent).groupBy("width", "curve", "window", "part")
        found = found.applyInArrow(compared, "query_id long, vec_id long, score double")
        # The same pair comes from many windows with the same score but for the last digits.
        pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return pairs.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select(*answer)

    def compared(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        is_query = np.asarray(group["query_id"].is_valid())
        names, ids, scores = [], [], []
        if is_query.any() and not is_query.all():
            vectors = units_of(matrix(group["vector"].combine_chunks()))
            candidates = vectors[~is_query]
            members = group["ids"].filter(pa.array(~is_query)).to_pylist()
            for query_id, query in zip(group["query_id"].to_numpy()[is_query].astype(np.int64), vectors[is_query], strict=True):
                for score, other in closest(candidates @ query, members, query_id, k, lambda i, q=query: float(candidates[i].dot(q))):
                    names.append(query_id)
                    ids.append(other)
                    scores.append(-score)
        return pa.table({"query_id": pa.array(names, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    answers = met(asked, 1, settings.curves)
    # Up to two windows are all met.
    several = [width for width, its in dealt.items() if its.windows > 2]
    if not several:
        return answers
    answers = work.stored(answers, "answers")
    full = answers.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    in_several = asked.filter(F.size("vector").isin(several)).select("vec_id").distinct()
    short = work.stored(asked.join(full, "vec_id", "left_anti").join(in_several, "vec_id", "left_semi"), "short")
    if short.isEmpty():
        return answers
    found = met(short, None, 1)
    return answers.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*answer).unionByName(found)
