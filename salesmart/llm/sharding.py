"""Shards that all match the mixture of sources, by proportional interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace, ranked


def interleaved_shards(documents: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``, ``source``) with its shard and slot.

    The rows of each source are put in a seeded order; a row's fraction is its
    rank there over the source's rows. All rows sorted by fraction are cut into
    ``shards`` runs whose lengths differ by one at most, so each holds every
    source in its share (law ``rows``). Ranks come from range-partitioned sorts,
    never from a window over a source.

    The order depends on seed, ``doc_id`` and text only, so reruns agree; rows
    that repeat both take any order among themselves. A null source is a source
    of its own, a null text counts as empty.

    Returns ``doc_id, source, size`` (UTF-8 bytes plus 1), ``text_crc32, shard, slot``.
    """
    work = Workspace(documents.sparkSession, "sharding")
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id",
        "source",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # A null source sorts apart from every text.
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("none")).alias("stratum"),
        F.xxhash64(F.lit(seed), "doc_id").alias("seeded"),
    )
    in_source = work.stored(
        ranked(work, rows, "by_source", "stratum", "seeded", "doc_id", "text_crc32"), "in_source"
    )
    work.drop("by_source")
    sources = work.stored(
        in_source.groupBy("stratum").agg(F.min("position").alias("first"), F.count("*").alias("of_source")), "sources"
    )
    fractions = in_source.join(sources, "stratum").withColumn(
        "fraction", (F.col("position") - F.col("first") + 0.5) / F.col("of_source")
    )
    spread = ranked(
        work,
        fractions.select("doc_id", "source", "size", "text_crc32", "fraction", "seeded", "stratum"),
        "spread",
        "fraction",
        "seeded",
        "stratum",
        "doc_id",
        "text_crc32",
    )
    total = in_source.count()
    # Position p goes to shard p * shards div total, whose first position is
    # shard * total / shards rounded up.
    return spread.withColumn("shard", F.expr(f"cast(position * {shards} div {max(total, 1)} as int)")).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "shard",
        F.expr(f"position - (shard * {total}L + {shards - 1}) div {shards}").alias("slot"),
    )
