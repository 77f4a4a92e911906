"""A mix of overlapping sources to target weights, by min-cost flow."""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from salesmart.llm.tables import Workspace, ranked

# Places in the seeded order, and how many bits of them one round settles.
ORDER_BITS = 48
STEP_BITS = 12


def word_count(text: str | Column = "text") -> Column:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_targets(sizes: Mapping[str | None, int], weights: Sequence[int], share: float, limit: float) -> dict:
    """``share`` of all sizes, dealt by weight to the sources in code-point order (null
    last); a source gets ``limit`` times its size at most, and what it leaves is dealt
    again to the others by weight until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, free, left = {}, list(order), share * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > limit * sizes[s]]
        if not over:
            return targets | {s: unit * weight[s] for s in free}
        for s in over:
            targets[s] = float(limit * sizes[s])
            left -= targets[s]
        free = [s for s in free if s not in targets]
    return targets


def routed(patterns: Sequence[tuple[frozenset, int]], quotas: Mapping, copies: int) -> list[int]:
    """Words each membership pattern gives at the least total cost.

    A flow from the patterns' capacity to the sources' quotas. The k-th copy of a
    pattern costs k a word, so repeats come last and are spread (convex costs). The
    graph of patterns and sources falls into parts that share no source. A part of one
    pattern and one source gives what both allow; the others are flows of their own.
    """
    part: dict = {s: s for s in quotas}

    def head(s):
        while part[s] != s:
            part[s] = part[part[s]]
            s = part[s]
        return s

    for members, _ in patterns:
        first = None
        for n, s in enumerate(members):
            if n:
                part[head(s)] = head(first)
            else:
                first = s
    together: dict = {}
    for i, (members, _) in enumerate(patterns):
        if members:
            together.setdefault(head(next(iter(members))), []).append(i)
    given = [0] * len(patterns)
    for group in together.values():
        members, words = patterns[group[0]]
        if len(group) == 1 and len(members) == 1:
            given[group[0]] = min(quotas[next(iter(members))], words * copies)
            continue
        some = [patterns[i] for i in group]
        own = sorted(set().union(*(m for m, _ in some)), key=lambda s: (s is None, s or ""))
        for i, words in zip(group, cheapest_flow(some, {s: quotas[s] for s in own}, copies), strict=True):
            given[i] = words
    return given


def cheapest_flow(patterns: Sequence[tuple[frozenset, int]], quotas: Mapping, copies: int) -> list[int]:
    """``routed`` for one part of the graph.

    Distances from the start are found once for each length of the shortest path, of
    which there are few; then the words of all shortest paths flow at once, level by
    level (blocking flows), before the distances are looked at again.
    """
    start, end = 0, 1
    source_node = {s: 2 + i for i, s in enumerate(quotas)}
    edges: list[list[int]] = []  # to, capacity, cost; the reverse edge is at index ^ 1
    out: list[list[int]] = [[] for _ in range(2 + len(quotas) + len(patterns))]

    def connect(a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[x].append(len(edges))
            edges.append([y, c, k])
        return len(edges) - 2

    given = []
    for i, (members, words) in enumerate(patterns):
        node = 2 + len(quotas) + i
        given.append([connect(start, node, words, k) for k in range(copies)])
        for s in sorted(members, key=lambda s: (s is None, s or "")):
            connect(node, source_node[s], words * copies, 0)
    for s, quota in quotas.items():
        connect(source_node[s], end, quota, 0)

    def distances() -> dict[int, int]:
        cost, queue, waiting = {start: 0}, deque([start]), {start}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in out[a]:
                b, capacity, price = edges[e]
                if capacity and cost[a] + price < cost.get(b, 1 << 60):
                    cost[b] = cost[a] + price
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        return cost

    def levels(cost: dict[int, int]) -> dict[int, int]:
        """Steps from the start along edges of shortest paths."""
        level, queue = {start: 0}, deque([start])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                b, capacity, price = edges[e]
                if capacity and b not in level and cost.get(b) == cost[a] + price:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def push(cost: dict[int, int], level: dict[int, int]) -> None:
        """A blocking flow: paths that go one level up a step, until none is left."""
        turn, path, node = {a: 0 for a in level}, [], start
        while True:
            if node == end:
                amount = min(edges[e][1] for e in path)
                for e in path:
                    edges[e][1] -= amount
                    edges[e ^ 1][1] += amount
                full = next(n for n, e in enumerate(path) if not edges[e][1])
                node = edges[path[full] ^ 1][0]
                del path[full:]
            for e in out[node][turn[node] :]:
                b, capacity, price = edges[e]
                if capacity and level.get(b) == level[node] + 1 and cost[b] == cost[node] + price:
                    path.append(e)
                    node = b
                    break
                turn[node] += 1
            else:
                if node == start:
                    return
                node = edges[path.pop() ^ 1][0]
                turn[node] += 1

    cost = distances()
    while end in cost:
        level = levels(cost)
        while end in level:
            push(cost, level)
            level = levels(cost)
        cost = distances()
    return [sum(edges[e ^ 1][1] for e in es) for es in given]


PATTERN = StructField("pattern", ArrayType(StringType()))
CHOICE = StructType([PATTERN, StructField("base", LongType()), StructField("end", LongType())])
PLAN = StructType([PATTERN, StructField("words", LongType()), StructField("taken", LongType())])
OPEN = StructType([PATTERN, StructField("start", LongType()), StructField("want", LongType())])


def mixed(
    documents: DataFrame,
    sources: str | Column,
    size: Column,
    weights: Sequence[int],
    share: float = 1.5,
    copies: int = 2,
    seed: int = 17,
    max_patterns: int | None = None,
    driver_patterns: int = 100_000,
) -> DataFrame:
    """One row per row of ``documents`` with the words of it that a mix takes.

    ``sources`` is an array of the sources a document belongs to (its membership
    pattern; an array holding null for none), ``size`` its words. Sources get
    ``capped_targets``; ``routed`` gives every pattern the words it has to supply.
    A pattern gives its documents whole, ``base`` times each, and once more those
    first in a seeded order until the words asked for are reached as nearly as
    whole documents allow. No document is taken more than ``copies`` times.

    The driver sees one row per pattern. Of more than ``driver_patterns`` it sees only
    those that share a source with a pattern of several, and raises if these alone are
    more; the others need no flow, and all else is done in tables. More than
    ``max_patterns`` of any kind, if given, raise. The end of the seeded order is found by summing ranges of
    it, so no task sorts a pattern. Reruns agree. Rows without words
    are taken ``base`` times, at 0 words. Rows that repeat a ``doc_id`` stand or
    fall together.

    Returns ``doc_id, pattern, size, source_size, target, copies, taken``; the third
    and fourth are those of the pattern's first source.
    """
    work = Workspace(documents.sparkSession, "mixing")
    rows = work.stored(
        documents.select(
            "doc_id",
            F.sort_array(F.array_distinct(F.col(sources) if isinstance(sources, str) else sources)).alias("pattern"),
            size.cast("long").alias("size"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 64 - ORDER_BITS).alias("seeded"),
        ),
        "rows",
    )
    by_pattern = work.stored(rows.groupBy("pattern").agg(F.sum("size").alias("words")), "patterns")
    if max_patterns is not None and by_pattern.limit(max_patterns + 1).count() > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    if by_pattern.limit(driver_patterns + 1).count() > driver_patterns:
        chosen, described = _many(work, rows, by_pattern, weights, share, copies, driver_patterns)
    else:
        chosen, described = _few(work, rows, by_pattern, weights, share, copies)
    return (
        rows.join(chosen, "pattern")
        .withColumn("source", F.element_at("pattern", 1))
        .join(described, F.col("source").eqNullSafe(F.col("described")))
        .withColumn("copies", F.col("base") + (F.col("seeded") <= F.col("end")).cast("long"))
        .select("doc_id", "pattern", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def _few(
    work: Workspace, rows: DataFrame, by_pattern: DataFrame, weights: Sequence[int], share: float, copies: int
) -> tuple[DataFrame, DataFrame]:
    """``pattern, base, end`` and ``described, source_size, target``, reckoned on the driver."""
    found = by_pattern.collect()
    found.sort(key=lambda r: [(s is None, s or "") for s in r["pattern"]])
    patterns = [(frozenset(r["pattern"]), r["words"]) for r in found]
    sizes: dict = {}
    for members, words in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + words
    targets = capped_targets(sizes, weights, share, copies)
    quotas = {s: round(t) for s, t in targets.items()}
    taken = routed(patterns, quotas, copies)
    plan = [
        (list(r["pattern"]), min(copies, t // r["words"]) if r["words"] else 1, t % r["words"] if r["words"] else 0)
        for r, t in zip(found, taken, strict=True)
    ]
    ends = _ends(work, rows, [(p, extra) for p, _, extra in plan if extra])
    # One row per pattern: at most driver_patterns.
    chosen = [(p, base, ends.get(tuple(p), -1)) for p, base, _ in plan]
    described = [(s, n, float(targets[s])) for s, n in sizes.items()]
    return (
        F.broadcast(work.spark.createDataFrame(chosen, CHOICE)),
        F.broadcast(work.spark.createDataFrame(described, "described string, source_size long, target double")),
    )


def _many(
    work: Workspace, rows: DataFrame, by_pattern: DataFrame, weights: Sequence[int], share: float, copies: int, most: int
) -> tuple[DataFrame, DataFrame]:
    """As ``_few``, in tables. A source that is in no pattern of several gives its quota;
    the patterns of the others, ``most`` at most, are routed on the driver."""
    each = by_pattern.select(F.explode("pattern").alias("described"), "words")
    sizes = each.groupBy("described").agg(F.sum("words").alias("source_size"))
    described = work.stored(_targets(work, sizes, weights, share, copies), "targets")
    quotas = described.select("described", F.rint("target").cast("long").alias("quota"))
    several = by_pattern.filter(F.size("pattern") != 1)
    tied = work.stored(several.select(F.explode("pattern").alias("tied")).distinct(), "tied")
    singles = by_pattern.filter(F.size("pattern") == 1).withColumn("described", F.element_at("pattern", 1))
    of_tied = F.col("described").eqNullSafe(F.col("tied"))
    entangled = several.unionByName(singles.join(tied, of_tied, "left_semi").drop("described"))
    found = entangled.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} overlapping membership patterns")
    found.sort(key=lambda r: [(s is None, s or "") for s in r["pattern"]])
    of = {r["described"]: r["quota"] for r in quotas.join(tied, of_tied, "left_semi").collect()}
    taken = routed([(frozenset(r["pattern"]), r["words"]) for r in found], of, copies)
    plan = [(list(r["pattern"]), r["words"], t) for r, t in zip(found, taken, strict=True)]
    alone = singles.join(tied, of_tied, "left_anti").withColumnRenamed("described", "source")
    alone = alone.join(quotas, F.col("source").eqNullSafe(F.col("described"))).select(
        "pattern", "words", F.least("quota", F.col("words") * copies).alias("taken")
    )
    plan = alone.unionByName(work.spark.createDataFrame(plan, PLAN))
    words, taken = F.col("words"), F.col("taken")
    plan = plan.select(
        "pattern",
        F.when(words > 0, F.least(F.lit(copies).cast("long"), F.floor(taken / words).cast("long"))).otherwise(1).alias("base"),
        F.when(words > 0, taken % words).otherwise(0).alias("want"),
    )
    plan = work.stored(plan, "plan")
    ends = _ends_in_tables(work, rows, plan.filter("want > 0").select("pattern", "want"))
    return plan.join(ends, "pattern", "left").select("pattern", "base", F.coalesce("end", F.lit(-1)).alias("end")), described


def _targets(work: Workspace, sizes: DataFrame, weights: Sequence[int], share: float, limit: int) -> DataFrame:
    """``capped_targets`` of a table ``described, source_size``: the unit of a weight rises
    until no more sources are above their limit. The driver sees sums, once a round."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    placed = ranked(work, sizes, "sources", F.asc_nulls_last("described"))
    placed = work.stored(placed.select("described", "source_size", weight.alias("weight")), "weights")
    total = placed.agg(F.sum("source_size")).first()[0]
    unit, capped = 0.0, -1
    while True:
        above = F.lit(unit) * F.col("weight") > F.col("source_size") * limit
        row = placed.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("source_size") * limit)), F.lit(0)).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if row["n"] == capped or not row["free"]:
            target = F.when(above, (F.col("source_size") * limit).cast("double")).otherwise(F.lit(unit) * F.col("weight"))
            return placed.select("described", "source_size", target.alias("target"))
        unit, capped = (share * total - row["given"]) / row["free"], row["n"]


def _ends(work: Workspace, rows: DataFrame, wanted: list[tuple[list, int]]) -> dict[tuple, int]:
    """The place in the seeded order up to which each pattern's rows hold the words wanted.

    Each round sums the words of 4096 equal ranges of what is left of a pattern's
    order and goes on in the range in which the sum is reached, until that holds
    one row (or rows at one place). The driver sees one row a pattern and round.
    Of the last row the nearer side is taken.
    """
    open_at = {tuple(p): (0, extra) for p, extra in wanted}  # start of the range, words still wanted
    ends: dict[tuple, int] = {}
    for shift in range(ORDER_BITS - STEP_BITS, -1, -STEP_BITS):
        if not open_at:
            break
        at = rows.sparkSession.createDataFrame([(list(p), *state) for p, state in open_at.items()], OPEN)
        for row in _crossed(rows, F.broadcast(at), shift).collect():
            key, place, rest = tuple(row["pattern"]), row["range"], row["want"] - row["upto"] + row["words"]
            open_at[key] = (place << shift, rest)
            if row["n"] == 1 or shift == 0:
                del open_at[key]
                ends[key] = (place + (2 * rest >= row["words"]) << shift) - 1
    return ends


def _crossed(rows: DataFrame, at: DataFrame, shift: int) -> DataFrame:
    """For each open range in ``at`` the part of it in which the words wanted are reached."""
    width = 1 << (shift + STEP_BITS)
    sums = (
        rows.join(at, "pattern")
        .filter((F.col("seeded") >= F.col("start")) & (F.col("seeded") < F.col("start") + F.lit(width)))
        .groupBy("pattern", "want", F.shiftright(F.col("seeded"), shift).alias("range"))
        .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    )
    # At most 4096 rows a pattern.
    in_order = Window.partitionBy("pattern").orderBy("range")
    return sums.withColumn("upto", F.sum("words").over(in_order)).filter(
        (F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("words") < F.col("want"))
    )


def _ends_in_tables(work: Workspace, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``_ends`` of a table ``pattern, want``, as ``pattern, end``."""
    at, ends = wanted.withColumn("start", F.lit(0).cast("long")), []
    for shift in range(ORDER_BITS - STEP_BITS, -1, -STEP_BITS):
        crossed = _crossed(rows, at, shift).withColumn("rest", F.col("want") - F.col("upto") + F.col("words"))
        crossed = work.stored(crossed, f"crossed{shift}")
        done = (F.col("n") == 1) | F.lit(shift == 0)
        side = (2 * F.col("rest") >= F.col("words")).cast("long")
        ends.append(crossed.filter(done).select("pattern", (F.shiftleft(F.col("range") + side, shift) - 1).alias("end")))
        at = crossed.filter(~done).select("pattern", F.col("rest").alias("want"), F.shiftleft("range", shift).alias("start"))
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return found
