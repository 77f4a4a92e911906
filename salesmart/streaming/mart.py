"""Keeping a daily mart up to date with the lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesmart.operators.loads import dates_of, on_dates, replace_touched_dates
from salesmart.plans.sales import LAKE_SCHEMA, daily_mart, staged_sales
from salesmart.sources.lake import BATCH, read_dataset

EVERY = "1 hour"


def refresh_dates(
    spark: SparkSession,
    lake_path: str,
    mart_path: str,
    days: list,
    build: Callable[[DataFrame], DataFrame],
    schema: str = LAKE_SCHEMA,
    date_column: str = "event_date",
) -> None:
    """Build the given dates of the mart again from all their lake rows.

    Distinct counts cannot be added up, so touched dates are recomputed; the other
    dates are neither read nor written. Running it twice gives the same mart.
    """
    rows = on_dates(read_dataset(spark, lake_path, schema), date_column, days)
    replace_touched_dates(build(rows), mart_path, date_column)


def sales_mart(rows: DataFrame) -> DataFrame:
    return daily_mart(staged_sales(rows))


def start_mart_stream(
    spark: SparkSession,
    lake_path: str,
    mart_path: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame] = sales_mart,
    schema: str = LAKE_SCHEMA,
    date_column: str = "event_date",
    every: str | None = EVERY,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Follow the lake's new files and refresh the mart for the dates they hold.

    The stream reads only the date of the new rows, which is a partition value,
    so following the lake opens no data column. A micro-batch that is run again
    after a failure rebuilds the same dates.
    """
    # Files that retention or compaction removed are no loss: their dates come with
    # the files that took their place, or are gone.
    reader = spark.readStream.schema(f"{schema}, {BATCH} STRING").option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def refresh(batch: DataFrame, _: int) -> None:
        days = dates_of(batch, date_column)
        if days:
            refresh_dates(batch.sparkSession, lake_path, mart_path, days, build, schema, date_column)

    writer = (
        reader.parquet(lake_path)
        .select(date_column)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
