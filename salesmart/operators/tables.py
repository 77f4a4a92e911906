"""Catalog tables and views, and how their files are laid out."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import AtomicType, StructType

from salesmart.sources.lake import spread_for_write

# Size of a range in a sorted write, as estimated, and the most ranges there can be:
# the estimate of a join may be far too large. A task sorts one range, and rows that were
# read from compressed files take some ten times the estimate in its memory.
FILE_BYTES = 64 * 1024**2
MOST_FILES = 100_000


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    if_not_exists: bool = True,
) -> None:
    """A Parquet table; ``columns`` may hold DEFAULT and COMMENT clauses."""
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    guard = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(f"CREATE TABLE {guard}{name} ({columns}) USING parquet{partitions}{place}")


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple], columns: str | StructType) -> None:
    """Append literal rows; columns of the table that ``columns`` leaves out get their defaults."""
    append_rows(spark.createDataFrame(list(rows), columns), name)


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a table by column name; columns that ``df`` leaves out get their defaults."""
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    names = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {name} ({names}) SELECT {names} FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def with_computed(
    df: DataFrame,
    defaults: Mapping[str, Column] | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add default columns where ``df`` has none of that name, then derived ones over all columns.

    Called before a write it stores the derived columns, in a view it computes
    them when they are read.
    """
    missing = {name: value for name, value in (defaults or {}).items() if name not in df.columns}
    return df.withColumns(missing).withColumns(dict(derived or {}))


def commented(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments, which a table written from ``df`` keeps."""
    for name, comment in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": comment})
    return df


def full_refresh(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> str:
    """Rebuild ``name`` as a new table and switch to it in one step; returns the table behind it.

    ``name`` is a view over the current build, so readers see the old rows or the
    new ones and a failed build changes nothing. The build before stays for the
    readers that still use it; older ones are dropped.
    """
    spark = df.sparkSession
    database, _, plain = name.rpartition(".")
    prefix = f"{database}." if database else ""
    earlier = builds_of(spark, name)
    build = f"{prefix}{plain}__build_{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}"
    writer = spread_for_write(df, partition_by).write.format("parquet").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(build)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {build}")
    for old in earlier[:-1]:
        drop_table(spark, f"{prefix}{old}")
    return build


def builds_of(spark: SparkSession, name: str) -> list[str]:
    """The build tables of a view, oldest first."""
    database, _, plain = name.rpartition(".")
    place = f" IN {database}" if database else ""
    tables = spark.sql(f"SHOW TABLES{place} LIKE '{plain}__build_*'").collect()
    return sorted(row["tableName"] for row in tables)


def write_sorted(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    spread_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Files that hold ranges of the sort key and are sorted inside.

    Readers skip files and row groups by the key. There are as many ranges as
    Spark's own estimate of the input's size asks for. ``spread_by`` extends the
    ranges, so one key value with very many rows is split over several tasks; by
    default all other columns that can be sorted do.
    """
    if spread_by is None:
        spread_by = [f.name for f in df.schema.fields if f.name not in order_by and isinstance(f.dataType, AtomicType)]
    key = [*order_by, *spread_by]
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    (
        df.repartitionByRange(min(MOST_FILES, max(1, -(-size // file_bytes))), *key)
        .sortWithinPartitions(*key)
        .write.mode(mode)
        .options(**(options or {}))
        .parquet(path)
    )


def compression(codec: str, level: int | None = None) -> dict[str, str]:
    """Writer options for a Parquet codec, with a level for ``zstd``."""
    chosen = {"compression": codec}
    if level is not None:
        chosen[f"parquet.compression.codec.{codec}.level"] = str(level)
    return chosen
