"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace

# The characters a comparison ignores: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
BLOCK_BYTES = 2048
# Stands for the missing right half of an odd tail; names are never that small.
NO_NAME = -(2**63)


def normalised(text: str = "text"):
    return F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def text_identities(documents: DataFrame, work: Workspace, block_bytes: int, key_bits: int) -> DataFrame:
    """One row per row of ``documents`` with ``row`` and ``(depth, name)``, equal exactly for equal texts.

    Each text is cut into blocks. The distinct blocks are sorted and numbered, then
    adjacent numbers are paired and the distinct pairs numbered, until a text has
    one number. A block is looked up by a 64-bit key where the key is that of a
    single block among all, which the table of distinct blocks shows; blocks that
    share a key are looked up by their bytes. So no two texts can get one name.
    """
    blocks = F.expr(
        f"transform(sequence(0, greatest(0, (octet_length(body) - 1) div {block_bytes})),"
        f" i -> substring(body, cast(i * {block_bytes} + 1 as int), {block_bytes}))"
    )
    key = "xxhash64(b)" if key_bits >= 64 else f"pmod(xxhash64(b), {1 << key_bits})"
    bodies = documents.select("doc_id", F.col("text"), normalised().cast("binary").alias("body"))

    distinct = (
        bodies.select(F.explode(blocks).alias("b"))
        .select(F.expr(key).alias("key"), F.col("b").alias("block"))
        .distinct()
        .sortWithinPartitions("key", "block")
    )
    names = work.stored(distinct.select("key", F.monotonically_increasing_id().alias("name")), "names")
    clashes = work.stored(names.groupBy("key").count().filter("count > 1").select("key"), "clashes")
    clash = not clashes.isEmpty()

    columns = [
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("n_points"),
        F.sha2("body", 256).alias("text_sha256"),
        F.expr(f"transform(blocks, b -> {key})").alias("keys"),
    ]
    cut = bodies.withColumn("blocks", blocks)
    rows = work.stored(cut.select(*columns, *(["blocks"] if clash else [])), "rows")
    placed = rows.select(
        "row",
        F.size("keys").alias("left_over"),
        F.posexplode(F.arrays_zip("keys", "blocks") if clash else F.arrays_zip("keys")).alias("pos", "at"),
    ).select("row", "left_over", "pos", F.col("at.keys").alias("key"), *([F.col("at.blocks").alias("block")] if clash else []))
    if clash:
        by_bytes = work.stored(
            distinct.join(clashes, "key", "left_semi")
            .sortWithinPartitions("key", "block")
            .select("key", "block", (-1 - F.monotonically_increasing_id()).alias("exact")),
            "clash_names",
        )
        placed = (
            placed.join(by_bytes, ["key", "block"], "left")
            .join(names.join(clashes, "key", "left_anti"), "key", "left")
            .select("row", "left_over", "pos", F.coalesce("exact", "name").alias("name"))
        )
    else:
        placed = placed.join(names, "key").select("row", "left_over", "pos", "name")

    done = []
    depth, longest = 0, rows.agg(F.max(F.size("keys"))).first()[0] or 1
    while True:
        done.append(placed.filter("left_over = 1").select("row", F.lit(depth).alias("depth"), "name"))
        if longest <= 1:
            break
        depth, longest = depth + 1, (longest + 1) // 2
        pairs = work.stored(
            placed.filter("left_over > 1")
            .groupBy("row", F.expr("(left_over + 1) div 2").cast("int").alias("left_over"), F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(NO_NAME)).alias("b"),
            ),
            f"pairs{depth}",
        )
        pair_names = work.stored(
            pairs.select("a", "b")
            .distinct()
            .sortWithinPartitions("a", "b")
            .select("a", "b", F.monotonically_increasing_id().alias("name")),
            f"names{depth}",
        )
        placed = pairs.join(pair_names, ["a", "b"]).select("row", "left_over", "pos", "name")
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return rows.drop("keys", "blocks").join(named, "row")


def exact_duplicates(documents: DataFrame, block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``): which row of its equals stays.

    Texts are equal when they are after removing the characters of ``BLANKS``.
    Of equal texts the row with the most code points stays, then the smallest
    ``doc_id`` (none comes last), then the first row read; so exactly one stays,
    also of rows that repeat a ``doc_id``. A null text counts as empty, and all
    empty texts are equal. Other columns are ignored. ``key_bits`` below 64 makes
    block keys clash, for tests.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    work = Workspace(documents.sparkSession, "exact-dedup")
    known = work.stored(text_identities(documents, work, block_bytes, key_bits), "known")
    groups = work.stored(
        known.groupBy("depth", "name").agg(
            F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"),
            F.count("*").alias("group_size"),
        ),
        "groups",
    )
    work.drop("names", "clashes", "clash_names", "rows", *(f"{kind}{depth}" for kind in ("pairs", "names") for depth in range(1, 64)))
    return known.join(groups, ["depth", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
