"""What was loaded, and what is loaded next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.operators.keys import distinct_keys
from salesmart.session import remove_folder
from salesmart.sources.lake import read_dataset


def load_audit(listing: DataFrame, details: DataFrame, keys: Sequence[str], date_column: str) -> DataFrame:
    """Per load date: rows listed, rows with details, rows without.

    The listing is counted per key before the join, so a key listed very often
    joins as one row.
    """
    listed = listing.groupBy(*dict.fromkeys([*keys, date_column])).agg(F.count(F.lit(1)).alias("_listed"))
    found = distinct_keys(details, keys).withColumn("_found", F.lit(True))
    total = F.sum("_listed")
    detailed = F.sum(F.when(F.col("_found"), F.col("_listed")).otherwise(0))
    return (
        listed.join(found, list(keys), "left")
        .groupBy(date_column)
        .agg(total.alias("listed"), detailed.alias("detailed"), (total - detailed).alias("missing"))
    )


# Finished dates as intervals without gaps between the dates of one.
FINISHED = "first DATE, last DATE"
VERSION = "version"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of the cursor's table, newest first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}=*/_SUCCESS")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(folder) or []
    return sorted((int(f.getPath().getParent().getName().split("=")[1]) for f in found), reverse=True)


def finished_intervals(spark: SparkSession, path: str) -> DataFrame:
    """The finished load dates: a row for each stretch of dates without a gap."""
    newest = versions(spark, path)[:1]
    if not newest:
        return spark.createDataFrame([], FINISHED)
    return read_dataset(spark, f"{path}/{VERSION}={newest[0]}", FINISHED)


def merged_dates(intervals: DataFrame) -> DataFrame:
    """Intervals of dates with those that touch or overlap made one."""
    order = Window.orderBy("first", "last")
    upto = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > F.date_add(upto, 1), F.lit(True)).cast("int")
    island = F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = intervals.withColumn("starts", starts).withColumn("island", island)
    return marked.groupBy("island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def finished_dates(spark: SparkSession, path: str) -> set[dt.date]:
    """The load dates that were finished."""
    days = F.explode(F.sequence("first", "last"))
    return {row[0] for row in finished_intervals(spark, path).select(days).collect()}


def finish_date(spark: SparkSession, path: str, day: dt.date) -> None:
    """Note that everything of a load date is written, also when it had no rows.

    The table is written anew, one file of one row per stretch of dates, and read once
    it is complete; the version before it stays for readers that are at it.
    """
    older = versions(spark, path)
    added = spark.range(1).select(F.lit(day).alias("first"), F.lit(day).alias("last"))
    merged = merged_dates(finished_intervals(spark, path).unionByName(added))
    number = older[0] + 1 if older else 1
    merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/{VERSION}={number}")
    for old in older[1:]:
        remove_folder(spark, f"{path}/{VERSION}={old}")


def next_load_date(spark: SparkSession, path: str, first: dt.date) -> dt.date:
    """The earliest date from ``first`` on that is not finished: one row tells it, and it
    never depends on the rows that were loaded."""
    around = finished_intervals(spark, path).filter(F.lit(first).between(F.col("first"), F.col("last")))
    row = around.select(F.date_add("last", 1)).first()
    return row[0] if row else first


def rows_to_load(
    source: DataFrame,
    path: str,
    first: dt.date,
    load_date: dt.date | None = None,
    date_column: str = "load_date",
) -> DataFrame:
    """The source rows of the next load date; a given ``load_date`` wins over the stored state."""
    day = load_date or next_load_date(source.sparkSession, path, first)
    return source.filter(F.col(date_column) == F.lit(day))
