"""Which offsets of a topic were read: gaps, and records that came twice.

A stream that tolerates lost data goes on where the broker has removed records, and
says nothing. The ledger keeps, for each micro-batch, the intervals of offsets it
read; what is between them was never read, and where they overlap records came twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.session import folder_exists
from salesmart.sources.kafka import POSITION
from salesmart.sources.lake import BATCH, read_dataset, refuse_sink_log
from salesmart.streaming.lake import Prepare

PLACE = ("topic", "partition")
INTERVALS_SCHEMA = "topic STRING, partition INT, first BIGINT, last BIGINT, n_records BIGINT"
# Offsets whose records are ordered in one task.
STRETCH = 1_000_000


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals (``INTERVALS_SCHEMA``) with those that touch or overlap made one."""
    before = Window.partitionBy(*PLACE).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*PLACE).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    marked = intervals.withColumn("starts", starts.cast("int"))
    return (
        marked.withColumn("island", F.sum("starts").over(upto))
        .groupBy(*PLACE, "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_records").alias("n_records"))
        .drop("island")
    )


def read_intervals(records: DataFrame) -> DataFrame:
    """The intervals of offsets that records with their positions cover.

    Offsets are ordered within stretches of ``STRETCH``, so a partition that holds most
    of the records is spread, and the intervals of the stretches are merged.
    """
    stretch = F.floor(F.col("offset") / STRETCH)
    one = records.groupBy(*POSITION).agg(F.count(F.lit(1)).alias("n_records"))
    order = Window.partitionBy(*PLACE, "stretch").orderBy("offset")
    islands = one.withColumn("stretch", stretch).withColumn("island", F.col("offset") - F.row_number().over(order))
    pieces = islands.groupBy(*PLACE, "stretch", "island").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n_records").alias("n_records")
    )
    return merged_intervals(pieces.drop("stretch", "island"))


def note_intervals(records: DataFrame, ledger: str, label: str) -> None:
    """Keep the intervals of a micro-batch; noted again, they take the place of the former ones."""
    refuse_sink_log(records.sparkSession, ledger)
    read_intervals(records).write.mode("overwrite").parquet(f"{ledger}/{BATCH}={label}")


def tracked(decode: Callable[[DataFrame], DataFrame], ledger: str) -> Prepare:
    """For ``start_lake_stream`` over raw records with positions: notes what each micro-batch
    read, all records of it, and decodes it."""

    @contextmanager
    def prepare(batch: DataFrame, label: str, again: bool) -> Iterator[DataFrame]:
        note_intervals(batch, ledger, label)
        yield decode(batch.drop(*POSITION))

    return prepare


def noted_intervals(spark: SparkSession, ledger: str) -> DataFrame:
    """All intervals in the ledger, with the batch that read them."""
    schema = f"{INTERVALS_SCHEMA}, {BATCH} STRING"
    return read_dataset(spark, ledger, schema) if folder_exists(spark, ledger) else spark.createDataFrame([], schema)


def gaps(intervals: DataFrame, from_start: bool = True) -> DataFrame:
    """The offsets between the intervals, and with ``from_start`` those from 0 to the first."""
    order = Window.partitionBy(*PLACE).orderBy("first")
    before = F.coalesce(F.lag("last").over(order), F.lit(-1) if from_start else F.col("first") - 1)
    found = merged_intervals(intervals).withColumn("since", before + 1)
    return found.filter("first > since").select(
        *PLACE, F.lit("gap").alias("kind"), F.col("since").alias("first"), (F.col("first") - 1).alias("last")
    )


def overlaps(intervals: DataFrame) -> DataFrame:
    """The offsets that more than one interval holds: records that came twice or more."""
    edges = intervals.select(*PLACE, F.col("first").alias("at"), F.lit(1).alias("step")).unionByName(
        intervals.select(*PLACE, (F.col("last") + 1).alias("at"), F.lit(-1).alias("step"))
    )
    steps = edges.groupBy(*PLACE, "at").agg(F.sum("step").alias("step")).filter("step <> 0")
    order = Window.partitionBy(*PLACE).orderBy("at")
    depth = F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = steps.withColumn("depth", depth).withColumn("next", F.lead("at").over(order)).filter("depth > 1")
    several = spans.select(*PLACE, F.col("at").alias("first"), (F.col("next") - 1).alias("last"), F.lit(0).cast("long").alias("n_records"))
    return merged_intervals(several).select(*PLACE, F.lit("overlap").alias("kind"), "first", "last")


def offset_report(spark: SparkSession, ledger: str, from_start: bool = True) -> DataFrame:
    """Gaps and overlaps of all that a stream read: ``topic, partition, kind, first, last, n_offsets``."""
    noted = noted_intervals(spark, ledger).drop(BATCH)
    both = gaps(noted, from_start).unionByName(overlaps(noted))
    return both.withColumn("n_offsets", F.col("last") - F.col("first") + 1)
