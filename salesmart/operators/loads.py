"""Load modes for Parquet tables partitioned by a date.

A table is a folder whose first partition column is a date. Lost executors cost
repeated tasks only. After a failed job, the load is run again; one that rewrites
dates of the table itself is completed from its copy (``rewrite_dates``). Dates
collected here are partition values, at most one per day of the table, never
rows. Rows are counted in the table, where Spark adds up the footers of the
dates' files and opens no column.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from salesmart.functions.times import moment_literal, months_later
from salesmart.operators.key_dates import BUCKETS, build_key_dates, entries_of, is_complete, key_dates, note_keys
from salesmart.operators.keys import absent_rows, distinct_keys, same_key, upserted
from salesmart.operators.retention import keep_recent
from salesmart.operators.swaps import finish_swaps, plain_path, remove_folders, swap_files
from salesmart.session import folder_exists, remove_folder, working_folder
from salesmart.sources.lake import BATCH, MERGED, date_folder, read_day, read_dataset, refuse_sink_log, write_dataset

log = logging.getLogger(__name__)


def table_schema(batch: DataFrame, partition_by: Sequence[str]) -> StructType:
    """The schema as Spark reads it back: partition columns last."""
    fields = {f.name: f for f in batch.schema.fields}
    data = [f for name, f in fields.items() if name not in partition_by]
    return StructType([StructField(f.name, f.dataType) for f in [*data, *(fields[p] for p in partition_by)]])


def open_table(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]
) -> DataFrame:
    """The table, made empty first where it does not exist yet."""
    none = spark.createDataFrame([], schema)
    none.write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return read_dataset(spark, path, schema)


def replace_date(
    batch: DataFrame,
    path: str,
    day: dt.date,
    date_column: str = "load_date",
    partition_by: Sequence[str] = (),
) -> int:
    """Replace all rows of one date by the batch rows of that date; returns their number.

    It overwrites the date's own folder, so further partitions below it that the
    batch does not have vanish too, and a batch without rows empties the date.
    The batch must not read the table itself.
    """
    refuse_sink_log(batch.sparkSession, path)
    on_day = F.col(date_column).isNull() if day is None else F.col(date_column) == F.lit(day)
    rows = batch.filter(on_day).drop(date_column)
    folder = date_folder(path, date_column, day)
    write_dataset(
        rows, folder, partition_by, mode="overwrite", options={"partitionOverwriteMode": "static"}
    )
    return read_dataset(batch.sparkSession, folder, rows.schema).count()


def replace_touched_dates(df: DataFrame, path: str, date_column: str = "load_date") -> None:
    """Replace every date that has rows in ``df``; dates without rows stay as they are.

    The table must be partitioned by the date alone. New files are complete
    before the old ones go.
    """
    write_dataset(
        df, path, [date_column], mode="overwrite", options={"partitionOverwriteMode": "dynamic"}
    )


def clear_dates(
    spark: SparkSession, path: str, days: Iterable[dt.date | None], date_column: str = "load_date"
) -> None:
    """Drop the given dates with all that lies below them."""
    refuse_sink_log(spark, path)
    for day in days:
        remove_folder(spark, date_folder(path, date_column, day))


def dates_of(df: DataFrame, date_column: str) -> list[dt.date | None]:
    """The dates that occur, in order, None last; copies are merged in the map tasks."""
    found = [row[0] for row in df.select(date_column).distinct().collect()]
    return sorted(found, key=lambda day: (day is None, day or dt.date.min))


def on_dates(df: DataFrame, date_column: str, days: Sequence[dt.date | None]) -> DataFrame:
    """The rows of the given dates; only those partitions are read."""
    column = F.col(date_column)
    wanted = column.isin([day for day in days if day is not None])
    return df.filter(wanted | column.isNull() if None in days else wanted)


def rewrite_dates(
    df: DataFrame,
    path: str,
    days: Sequence[dt.date | None],
    date_column: str = "load_date",
    further: Sequence[str] = (),
) -> None:
    """Give the listed dates the rows of ``df``, which may read the table itself.

    ``further`` are the table's partitions below the date. The rows are first written beside the table, in the shared working folder, so
    nothing is read from the dates while they are replaced. A failure up to there
    leaves the table as it was. The folder is logged before the dates are swapped:
    after a failure in the swap, ``swap_dates`` with that folder completes it.
    """
    spark = df.sparkSession
    refuse_sink_log(spark, path)
    beside = working_folder(spark, "rewrite")
    write_dataset(df, beside, [date_column], mode="overwrite")
    log.info("swapping %s into %s for %s", beside, path, [str(day) for day in days])
    swap_dates(spark, beside, path, table_schema(df, [date_column]), days, date_column, further)


def swap_dates(
    spark: SparkSession,
    beside: str,
    path: str,
    schema: StructType,
    days: Sequence[dt.date | None],
    date_column: str = "load_date",
    further: Sequence[str] = (),
) -> None:
    """Give the listed dates the rows in the folder ``beside``, then remove it. Can be run again."""
    written = read_dataset(spark, beside, schema)
    if further:  # a dynamic overwrite would leave the partitions below a date that have no rows now
        for day in days:
            replace_date(read_day(spark, beside, day, schema, date_column), path, day, date_column, further)
        clear_dates(spark, path, [day for day in days if day not in dates_of(written, date_column)], date_column)
        remove_folder(spark, beside)
        return
    # Already laid out by date, so this write needs no shuffle.
    (
        written.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    kept = dates_of(written, date_column)
    clear_dates(spark, path, [day for day in days if day not in kept], date_column)
    remove_folder(spark, beside)


def upsert_by_key(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    date_column: str = "load_date",
    key_implies_date: bool | None = None,
    days: Sequence[dt.date | None] | None = None,
    index: str | None = None,
    buckets: int = BUCKETS,
) -> list[dt.date | None]:
    """Replace the table rows that share a key with the batch, add the rest; returns the dates rewritten.

    ``days`` are the dates the batch may have, where the caller knows them; a batch
    with rows on other dates raises. Where the key holds or implies the date, only
    these dates are read. Otherwise the key columns of the table are searched for
    other dates to rewrite, or with ``index`` the table's index in that folder
    (``operators.key_dates``, in so many ``buckets``): only the buckets of the batch's
    keys are read. An index that is not there yet, or was not built whole, is built.

    The batch is computed once: it and its distinct keys are written beside the
    table first. The joins then know their sizes, and as they join plain scans,
    AQE can split a table key that holds very many rows.
    """
    spark = batch.sparkSession
    beside = working_folder(spark, "upsert")
    batch.write.parquet(f"{beside}/rows")
    batch = read_dataset(spark, f"{beside}/rows", batch.schema)
    distinct_keys(batch, keys).write.parquet(f"{beside}/keys")
    new_keys = read_dataset(spark, f"{beside}/keys", batch.select(*keys).schema)
    table = open_table(spark, path, table_schema(batch, [date_column]), [date_column])
    present = dates_of(batch, date_column)
    others = [day for day in present if days is not None and day not in days]
    if others:
        remove_folder(spark, beside)
        raise ValueError(f"the batch has rows on {', '.join(map(str, others))}, which are not among its days")
    days = list(present if days is None else days)
    if key_implies_date is None:
        key_implies_date = date_column in keys
    if not key_implies_date and index is not None:
        if not is_complete(spark, index):
            build_key_dates(table, index, keys, date_column, buckets)
        found = entries_of(key_dates(spark, index, batch, keys, date_column), new_keys, keys, buckets)
        days += [day for day in dates_of(found, date_column) if day not in days]
        note_keys(batch, index, keys, date_column, buckets)
    elif not key_implies_date:
        moved = table.join(new_keys, same_key(table, new_keys, keys), "left_semi")
        days += [day for day in dates_of(moved, date_column) if day not in days]
    touched = on_dates(table, date_column, days)
    rewrite_dates(upserted(touched, batch, keys, new_keys), path, days, date_column)
    remove_folder(spark, beside)
    return days


def checked_dates(batch: DataFrame, keys: Sequence[str], date_column: str) -> list[dt.date]:
    """The dates of a batch; raises when a key is incomplete or occurs twice. One pass over the batch."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_date = (
        batch.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(date_column)
        .agg(
            F.sum(F.when(incomplete, F.col("_rows")).otherwise(0)).alias("incomplete"),
            F.count_if(~incomplete & (F.col("_rows") > 1)).alias("repeated"),
        )
        .collect()
    )
    for fault in ("incomplete", "repeated"):
        count = sum(row[fault] for row in per_date)
        if count:
            raise ValueError(f"{count} {fault} keys ({', '.join(keys)}) in the batch")
    return sorted(row[0] for row in per_date)


def insert_if_absent(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    date_column: str = "load_date",
    days: Sequence[dt.date] | None = None,
) -> int:
    """Append the batch rows whose key the table does not hold; returns their number.

    The key must hold the date, so only the batch's dates are read. The batch
    must have each key once (``last_per_key``); this is checked unless the
    batch's ``days`` are given.
    """
    if date_column not in keys:
        raise ValueError(f"the key must hold {date_column}")
    if days is None:
        days = checked_dates(batch, keys, date_column)
    spark = batch.sparkSession
    schema = table_schema(batch, [date_column])
    existing = on_dates(open_table(spark, path, schema, [date_column]), date_column, days)
    before = existing.count()
    write_dataset(absent_rows(batch, existing, keys), path, [date_column])
    return on_dates(read_dataset(spark, path, schema), date_column, days).count() - before


def load_together(
    batches: Mapping[str, DataFrame], keys: Sequence[str], date_column: str = "load_date"
) -> dict[str, int]:
    """Insert several batches, ``{table path: batch}``, after all of them passed their checks.

    Each batch is computed once and written to the working folder; checks and
    inserts read it there. A batch that fails its checks stops the load before
    any table is written. Spark has no transaction over tables: when a later
    write fails, running the load again adds what is missing and repeats nothing.
    """
    staged, beside = {}, {}
    try:
        for path, batch in batches.items():
            spark = batch.sparkSession
            beside[path] = working_folder(spark, "load")
            batch.write.parquet(beside[path])
            staged[path] = read_dataset(spark, beside[path], batch.schema)
        days = {path: checked_dates(batch, keys, date_column) for path, batch in staged.items()}
        return {path: insert_if_absent(batch, path, keys, date_column, days[path]) for path, batch in staged.items()}
    finally:
        for folder in beside.values():
            remove_folder(spark, folder)


def days_present(
    spark: SparkSession, path: str, days: Iterable[dt.date | None], schema: StructType, date_column: str
) -> DataFrame:
    """Several days of the dataset, whose first partition is the date: only their folders are listed."""
    folders = [date_folder(path, date_column, day) for day in days]
    folders = [folder for folder in folders if folder_exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def compact_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    days: Sequence[dt.date | None],
    date_column: str = "event_date",
) -> None:
    """Merge the batches of closed days of the lake, so that each has a few large files.

    Only these days' folders are listed, and one job reads and writes them all; what
    it read is then swapped for what it wrote, so rows that land meanwhile stay. Meant
    for days that no stream writes any more; a batch that is repeated later would add
    its rows again.
    """
    finish_swaps(spark, path)
    rows = days_present(spark, path, days, schema, date_column)
    old = [plain_path(spark, file) for file in rows.inputFiles()]
    if old:
        swap_files(rows.select(*schema.names).withColumn(BATCH, merged_batch(date_column)), path, old, [date_column, BATCH])


def merged_batch(date_column: str) -> Column:
    """The batch of rows that were in the lake before, on their date."""
    return F.concat(F.lit(MERGED), F.coalesce(F.col(date_column).cast("string"), F.lit("None")))


def append_day(rows: DataFrame, path: str, day: dt.date, date_column: str = "event_date") -> int:
    """Plain append of one day to a table by date; a day that it holds already raises."""
    spark = rows.sparkSession
    if read_day(spark, path, day, rows.schema, date_column).limit(1).count():
        raise ValueError(f"{path} holds {day} already")
    write_dataset(rows, path, [date_column])
    return read_day(spark, path, day, rows.schema, date_column).count()


def load_day(
    spark: SparkSession,
    lake_path: str,
    schema: StructType,
    day: dt.date,
    write: Callable[[DataFrame], object],
    date_column: str = "event_date",
) -> int:
    """Hand one day of the lake to ``write`` and return its rows; an empty day is not written.

    ``write`` calls ``append_jdbc``, ``replace_date`` or the like.
    """
    rows = read_day(spark, lake_path, day, schema, date_column)
    count = rows.count()
    if count:
        write(rows)
    return count


def expire_rows(
    spark: SparkSession,
    path: str,
    schema: StructType,
    moment: str,
    as_of: dt.datetime,
    months: int = 1,
    date_column: str = "event_date",
    further: Sequence[str] = (),
) -> list[dt.date]:
    """Drop the rows older than ``months`` from a table whose date is the day of ``moment``.

    ``further`` are the table's partitions below the date, as in the lake; ``schema``
    holds them too.

    Dates are left alone or emptied by their first and last moment. In the few dates in
    which the limit falls, one pass over ``moment`` tells which files hold expired rows,
    and which others too: the first go, and only files with both are read whole and
    rewritten, all in one job. Other files keep their names. Returns the dates changed.
    """
    finish_swaps(spark, path)
    table = read_dataset(spark, path, schema)
    limit = moment_literal(as_of)
    first = F.col(date_column).cast("timestamp")
    last = first + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND")
    days = (
        table.select(date_column)
        .distinct()
        .filter(months_later(first, months) <= limit)
        .select(date_column, (months_later(last, months) <= limit).alias("gone"))
        .collect()
    )
    gone = sorted(row[0] for row in days if row["gone"])
    partly = sorted(row[0] for row in days if not row["gone"])
    old = F.coalesce(months_later(F.col(moment), months) <= limit, F.lit(False))
    files = (
        days_present(spark, path, partly, schema, date_column)
        .select(date_column, old.alias("old"), F.col("_metadata.file_path").alias("file"))
        .groupBy(date_column, "file")
        .agg(F.bool_or("old").alias("some"), F.bool_and("old").alias("all"))
        .filter("some")
        .collect()
        if partly
        else []
    )
    mixed = [plain_path(spark, row["file"]) for row in files if not row["all"]]
    if files:
        rows = spark.createDataFrame([], schema)
        if mixed:
            rows = spark.read.schema(schema).option("basePath", path).parquet(*mixed)
            rows = keep_recent(rows, moment, as_of, months)
        if BATCH in further:
            rows = rows.withColumn(BATCH, merged_batch(date_column))
        swap_files(rows, path, [plain_path(spark, row["file"]) for row in files], [date_column, *further])
    refuse_sink_log(spark, path)
    remove_folders(spark, [date_folder(path, date_column, day) for day in gone])
    return sorted({*gone, *(row[0] for row in files)})
