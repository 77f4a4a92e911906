"""A daily mart that grows by what each micro-batch of the lake adds.

Below the mart's folder lie two tables by month (``period``) and micro-batch:

* ``orders``: each order of a group (date, region, category) once, in the batch that
  brought it first. A batch joins its own orders with those of the dates it touches,
  so distinct orders stay exact without reading a row of the lake again.
* ``parts``: for each group that a batch touched, what it adds to the group's counts
  and sums, new orders among them.

The mart is the sum of the parts. A batch costs what it holds plus the order keys of
its dates; nothing is rewritten. ``merge_period`` adds up the parts of a closed month.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmart.operators.key_index import LAYOUT, PERIOD, add_keys, layout_rows, month_of, seen_keys
from salesmart.operators.keys import same_key
from salesmart.operators.loads import rewrite_dates
from salesmart.plans.sales import GROUP, LAKE_SCHEMA, PARTS_SCHEMA, added_parts, additive_parts, mart_of_parts, staged_sales
from salesmart.session import remove_folder, working_folder
from salesmart.sources.lake import BATCH, MERGED, clear_batch, read_dataset, read_day, write_dataset
from salesmart.streaming.attempts import Attempt, Attempts

EVERY = "1 hour"
ORDERS, PARTS, ATTEMPTS = "orders", "parts", "attempts"
KEY = (*GROUP, "order_id")
ORDERS_SCHEMA = "event_date DATE, region STRING, category STRING, order_id STRING"


def batch_label(number: int) -> str:
    return f"{number:012d}"


def add_batch(sales: DataFrame, mart_path: str, label: str) -> None:
    """Add lake rows to the mart as the batch ``label``, of which nothing is stored yet."""
    spark = sales.sparkSession
    beside = working_folder(spark, "delta")
    try:
        # A hot group is spread over its orders.
        orders = staged_sales(sales).groupBy(*KEY).agg(*additive_parts())
        orders.write.parquet(f"{beside}/orders")
        orders = read_dataset(spark, f"{beside}/orders", orders.schema)
        known = seen_keys(orders, f"{mart_path}/{ORDERS}", ORDERS_SCHEMA).withColumn("known", F.lit(True))
        fresh = orders["order_id"].isNotNull() & known["known"].isNull()
        told = orders.join(known, same_key(orders, known, KEY), "left").select(*[orders[c] for c in orders.columns], fresh.alias("fresh"))
        told.write.parquet(f"{beside}/told")
        told = read_dataset(spark, f"{beside}/told", told.schema)
        add_keys(told.filter("fresh").select(*KEY), f"{mart_path}/{ORDERS}", label)
        parts = added_parts(told.withColumn("n_orders", F.col("fresh").cast("int")))
        parts = parts.withColumn(PERIOD, month_of("event_date")).withColumn(BATCH, F.lit(label))
        write_dataset(parts, f"{mart_path}/{PARTS}", [PERIOD, BATCH])
    finally:
        remove_folder(spark, beside)


def start_delta_mart_stream(
    spark: SparkSession,
    lake_path: str,
    mart_path: str,
    checkpoint: str,
    every: str | None = EVERY,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Follow the lake's new files and add what they hold to the mart, each row once.

    Late rows and further rows of known orders are rows like any others. A batch that
    is run again after a failure first removes what the earlier attempt wrote; one that
    was written whole is left as it is. Files of merged days hold rows that came before
    and are left out. Days that expire stay in the mart. Files that vanish before
    they were read, as when a day is merged too early, stop the stream.
    """
    reader = spark.readStream.schema(f"{LAKE_SCHEMA}, {BATCH} STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    attempts = Attempts(spark, f"{mart_path}/{ATTEMPTS}")

    def add(batch: DataFrame, number: int) -> None:
        attempt = attempts.begin(number)
        if attempt is Attempt.WRITTEN:
            return
        label = batch_label(number)
        if attempt is Attempt.AGAIN:
            for name in (ORDERS, PARTS):
                clear_batch(spark, f"{mart_path}/{name}", label)
        add_batch(batch, mart_path, label)
        attempts.finish(number)

    files = reader.parquet(lake_path).filter(~F.coalesce(F.col(BATCH).startswith(MERGED), F.lit(False)))
    writer = files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def mart_parts(spark: SparkSession, mart_path: str) -> DataFrame:
    """The parts of all finished batches: a batch in the making, or one that failed, is not seen."""
    hidden = [batch_label(n) for n in Attempts(spark, f"{mart_path}/{ATTEMPTS}").unfinished()]
    rows = layout_rows(spark, f"{mart_path}/{PARTS}", PARTS_SCHEMA)
    return rows.filter(~F.col(BATCH).isin(hidden)) if hidden else rows


def read_delta_mart(spark: SparkSession, mart_path: str) -> DataFrame:
    """The daily mart as of the last finished batch."""
    return mart_of_parts(mart_parts(spark, mart_path).drop(PERIOD, BATCH))


def merge_period(spark: SparkSession, mart_path: str, period: dt.date | None) -> None:
    """Give a month one row a group and few files, in place of a row and a file each batch.

    Run it while the stream stands, or for months it does not touch any more.
    """
    label = F.lit(f"merged-{period}")
    for name, schema in ((PARTS, PARTS_SCHEMA), (ORDERS, ORDERS_SCHEMA)):
        path = f"{mart_path}/{name}"
        rows = read_day(spark, path, period, f"{schema}, {LAYOUT}", PERIOD).drop(PERIOD, BATCH)
        rows = added_parts(rows) if name == PARTS else rows.sort("event_date")
        rows = rows.withColumn(PERIOD, F.lit(period).cast("date")).withColumn(BATCH, label)
        rewrite_dates(rows, path, [period], PERIOD, [BATCH])
