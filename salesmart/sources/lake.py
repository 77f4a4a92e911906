"""Partitioned Parquet datasets.

Paths are URIs; credentials and endpoints of an object store belong to the
caller's session or to ``options``.

The lake is laid out as ``event_date=.../batch=...``: the date first, so one day is
one folder, and below it the batch that wrote the rows, so that a batch which is
written again replaces itself. Streams, backfills, retention and compaction all
write this layout, and readers need no log of files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.session import folder_exists

LAKE_PARTITIONS = ("event_date",)
BATCH = "batch"
# How batches of rows begin that were in the lake before, in others.
MERGED = "compact-"
# Where a stream's own file sink keeps the list of its files: readers see only those.
SINK_LOG = "_spark_metadata"


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so that it gets few files.

    The rebalance hint lets AQE merge small partitions and split a hot one over
    several tasks by size; a plain repartition would leave it to one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_dataset(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = LAKE_PARTITIONS,
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    spread: bool = True,
) -> None:
    refuse_sink_log(df.sparkSession, path)
    rows = spread_for_write(df, partition_by) if spread else df
    writer = rows.write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def refuse_sink_log(spark: SparkSession, path: str) -> None:
    """Raise for a folder in which readers would not see what is written, or would miss what is removed."""
    if folder_exists(spark, f"{path}/{SINK_LOG}"):
        raise ValueError(f"{path} belongs to a stream's file sink, whose log hides other files")


def write_batch(
    df: DataFrame,
    path: str,
    batch: str,
    partition_by: Sequence[str] = LAKE_PARTITIONS,
    spread: bool = True,
    fresh: bool = False,
) -> None:
    """Add the rows to the lake as one batch; written again, it takes the place of its former self.

    A repeated batch must have rows on the same dates, which holds for a backfill of
    the same source. With ``fresh`` the caller knows that nothing of the batch is
    there, and the rows are appended, without the overwrite's moves in the driver.
    """
    rows = df.drop(BATCH).withColumn(BATCH, F.lit(batch))
    columns = [*partition_by, BATCH]
    if fresh:
        write_dataset(rows, path, columns, "append", spread=spread)
    else:
        write_dataset(rows, path, columns, "overwrite", {"partitionOverwriteMode": "dynamic"}, spread)


def clear_batch(spark: SparkSession, path: str, batch: str, levels: int = len(LAKE_PARTITIONS)) -> int:
    """Remove all that is left of a batch, on whatever dates; returns the folders removed.

    ``levels`` partitions lie above the batch. This lists the folders of the lake, so it
    is for a batch that failed, not for every one.
    """
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path, *["*=*"] * levels, f"{BATCH}={batch}"]))
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.globStatus(pattern) or []]
    for folder in found:
        files.delete(folder, True)
    return len(found)


def read_dataset(
    spark: SparkSession, path: str, schema: str | StructType, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Read with a given schema, columns in its order; partitions that are not in it are left out.

    Inference could turn a text partition into a number, and Spark would put the
    partition columns in the order of the folders.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.read.schema(schema).options(**(options or {})).parquet(path).select(*schema.names)


def date_folder(path: str, date_column: str, day: dt.date | None) -> str:
    return f"{path}/{date_column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def read_day(
    spark: SparkSession,
    path: str,
    day: dt.date | None,
    schema: str | StructType,
    date_column: str = "event_date",
) -> DataFrame:
    """One day of the dataset, whose first partition is the date: only its folder is listed."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    folder = date_folder(path, date_column, day)
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return read_dataset(spark, folder, schema, {"basePath": path})
