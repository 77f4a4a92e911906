"""Sales: change events to typed rows, staging rows and the daily mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.binary import decode_decimal
from salesmart.functions.times import from_epoch_micros, from_epoch_millis, second_text
from salesmart.functions.values import is_positive

# The row image inside a change event, and the operations that
# carry a first image (insert, snapshot read).
ROW_IMAGE = (
    "id BIGINT, order_id STRING, customer_id INT, product_id INT, product_name STRING, "
    "category STRING, quantity INT, unit_price STRING, discount_pct INT, total_price STRING, "
    "region STRING, city STRING, payment_method STRING, channel STRING, is_returned BOOLEAN, "
    "rating INT, created_at BIGINT"
)
EVENT = f"after STRUCT<{ROW_IMAGE}>, op STRING, ts_ms BIGINT"
ENVELOPE = f"before STRING, {EVENT}"
FIRST_IMAGE_OPS = ("c", "r")
RATINGS = (1, 5)

MONEY = ("unit_price", "total_price")
PARTITIONS = ("event_date",)

# The lake's columns as they are read back, partition columns last.
LAKE_SCHEMA = (
    "id BIGINT, order_id STRING, customer_id INT, product_id INT, product_name STRING, "
    "category STRING, quantity INT, unit_price DECIMAL(10,2), discount_pct INT, "
    "total_price DECIMAL(10,2), city STRING, payment_method STRING, channel STRING, "
    "is_returned BOOLEAN, rating INT, event_time TIMESTAMP, cdc_op STRING, cdc_ts TIMESTAMP, "
    "ingest_ts TIMESTAMP, has_discount BOOLEAN, region STRING, event_date DATE"
)
CHANGE_COLUMNS = ("cdc_op", "cdc_ts", "ingest_ts")
# Why a record was not decoded; null for rows that were.
REJECT_REASON = "reject_reason"


def is_first_image(event: Column, ops: Sequence[str] = FIRST_IMAGE_OPS) -> Column:
    return event["op"].isin(*ops) & event["after"]["id"].isNotNull()


def parse_changes(records: DataFrame, with_before: bool = False) -> DataFrame:
    """Change records (``value``, ``timestamp``) to ``event`` structs and ``ingest_ts``.

    One parse covers an envelope below ``payload`` and a bare one. An envelope
    that is itself JSON text is parsed again, only where the first parse found
    neither. The row before the change is JSON text and skipped unless asked for.
    """
    fields = ENVELOPE if with_before else EVENT
    text = F.col("value").cast("string")
    parsed = records.select(
        F.from_json(text, f"payload STRUCT<{fields}>, {fields}").alias("doc"),
        "value",
        F.col("timestamp").alias("ingest_ts"),
    )
    names = [*(["before"] if with_before else []), "after", "op", "ts_ms"]
    bare = F.struct(*[f"doc.{name}" for name in names])
    quoted = F.from_json(F.get_json_object(text, "$.payload"), fields)
    event = F.coalesce("doc.payload", F.when(F.col("doc.op").isNotNull(), bare), quoted)
    return parsed.select(event.alias("event"), "ingest_ts", "value")


def first_images(
    events: DataFrame,
    ops: Sequence[str] = FIRST_IMAGE_OPS,
    observe: Observation | str | None = None,
) -> DataFrame:
    """The events that carry a first image with a key, as columns ``after``, ``op``, ``ts_ms``, ``ingest_ts``.

    The filter runs on a one-element array that is then inlined: a plain filter
    would be pushed below the parse and parse every record twice. ``observe``
    counts the events read and kept.
    """
    if observe is not None:
        kept = F.count_if(is_first_image(F.col("event"), ops))
        events = events.observe(observe, F.count(F.lit(1)).alias("read"), kept.alias("kept"))
    wanted = F.filter(F.array("event"), lambda e: is_first_image(e, ops))
    return events.select("ingest_ts", F.inline(wanted)).select("after", "op", "ts_ms", "ingest_ts")


def sales_rows(
    images: DataFrame,
    scale: int = 2,
    lenient: bool = False,
    time_as_text: bool = False,
    also: Sequence[Column | str] = (),
) -> DataFrame:
    """First images as typed sales rows, for the lake, and the columns ``also``."""

    def field(name: str) -> Column:
        image = F.col(f"after.{name}")
        return decode_decimal(image, scale=scale, lenient=lenient) if name in MONEY else image

    names = [f.strip().split(" ")[0] for f in ROW_IMAGE.split(",")]
    moment = from_epoch_micros(F.col("after.created_at"))
    return images.select(
        *[field(name).alias(name) for name in names if name != "created_at"],
        (second_text(moment) if time_as_text else moment).alias("event_time"),
        F.to_date(moment).alias("event_date"),
        F.col("op").alias("cdc_op"),
        from_epoch_millis(F.col("ts_ms")).alias("cdc_ts"),
        "ingest_ts",
        is_positive(F.col("after.discount_pct")).alias("has_discount"),
        *also,
    )


def decode_or_reject(
    records: DataFrame,
    ops: Sequence[str] = FIRST_IMAGE_OPS,
    scale: int = 2,
    time_as_text: bool = False,
    observe: Observation | str | None = None,
) -> DataFrame:
    """``decode_changes`` for a stream that no record may stop.

    Records that are no change events, and first images with an amount that is no
    decimal, come out too, with their ``value`` and a ``reject_reason``. Updates
    and deletes are dropped. ``observe`` counts records, rows kept and rejects.
    """
    events = parse_changes(records)

    def broken(event: Column) -> Column:
        return event.isNull() | (event["op"].isNull() & event["after"].isNull())

    wanted = F.filter(
        F.array(F.struct("event", "ingest_ts", "value")),
        lambda r: F.coalesce(broken(r["event"]) | is_first_image(r["event"], ops), F.lit(False)),
    )
    images = events.select(F.inline(wanted)).select("event.after", "event.op", "event.ts_ms", "event", "ingest_ts", "value")
    bad = [F.col(f"after.{m}").isNotNull() & decode_decimal(F.col(f"after.{m}"), scale=scale, lenient=True).isNull() for m in MONEY]
    reason = F.when(broken(F.col("event")), F.lit("not a change event")).when(bad[0] | bad[1], F.lit("bad amount"))
    rows = sales_rows(images, scale, True, time_as_text, also=[reason.alias(REJECT_REASON), "value"])
    if observe is not None:
        kept = F.count_if(F.col(REJECT_REASON).isNull())
        rejected = F.count_if(F.col(REJECT_REASON).isNotNull())
        rows = rows.observe(observe, kept.alias("kept"), rejected.alias("rejected"))
    return rows


def decode_changes(
    records: DataFrame,
    ops: Sequence[str] = FIRST_IMAGE_OPS,
    scale: int = 2,
    lenient: bool = False,
    time_as_text: bool = False,
    observe: Observation | str | None = None,
) -> DataFrame:
    """Change records, streaming or not, to typed sales rows.

    Records that are not JSON, and updates and deletes, are dropped; ``observe``
    counts them. Bad decimals raise unless ``lenient``.
    """
    images = first_images(parse_changes(records), ops, observe)
    return sales_rows(images, scale, lenient, time_as_text)


def staging(columns: Sequence[str], ops: Sequence[str] = FIRST_IMAGE_OPS) -> tuple[list[str], str]:
    """The columns and the condition of the staging layer, for a DataFrame or a view."""
    low, high = RATINGS
    kept = [f"`{c}`" for c in columns if c not in CHANGE_COLUMNS]
    kept.append(f"CASE WHEN rating BETWEEN {low} AND {high} THEN rating END AS valid_rating")
    operations = ", ".join(f"'{op}'" for op in ops)
    return kept, f"cdc_op IN ({operations})"


def staged_sales(sales: DataFrame, ops: Sequence[str] = FIRST_IMAGE_OPS) -> DataFrame:
    """Lake rows without the change columns, and the rating where it is valid."""
    columns, condition = staging(sales.columns, ops)
    return sales.filter(condition).selectExpr(*columns)


def create_staged_view(
    spark: SparkSession, name: str, source: str, ops: Sequence[str] = FIRST_IMAGE_OPS
) -> None:
    """The staging layer as a view in the catalog over a table of lake rows."""
    columns, condition = staging(spark.table(source).columns, ops)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {source} WHERE {condition}")


def rounded_mean(value: Column) -> Column:
    """The mean of a decimal or integer, rounded half up once, from the exact sum and count."""
    return F.round(F.sum(value) / F.count(value), 2).cast("double")


def daily_mart(staged: DataFrame, ordered: bool = False) -> DataFrame:
    """Sales per day, region and category.

    Spark aggregates by group and order first and only then by group, so a hot
    group is spread over its orders and the last shuffle carries partial sums.
    """
    orders = F.count(F.lit(1))
    returned = F.count_if("is_returned")
    mart = staged.groupBy("event_date", "region", "category").agg(
        orders.alias("total_orders"),
        F.count_distinct("order_id").alias("unique_orders"),
        F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
        F.round(F.sum("total_price"), 2).cast("decimal(20,2)").alias("total_revenue"),
        rounded_mean(F.col("total_price")).alias("avg_order_value"),
        rounded_mean(F.col("valid_rating").cast("decimal(10,0)")).alias("avg_rating"),
        returned.alias("returned_orders"),
        F.round((returned * 100).cast("decimal(20,0)") / orders, 2).cast("double").alias("return_rate_pct"),
        F.count_if("has_discount").alias("discounted_orders"),
    )
    if ordered:
        mart = mart.orderBy(F.desc("event_date"), F.desc("total_revenue"))
    return mart


GROUP = ("event_date", "region", "category")
# What of a group adds up over its rows, in the order of ``additive_parts``.
PARTS_SCHEMA = (
    "event_date DATE, region STRING, category STRING, n_rows BIGINT, n_orders BIGINT, quantity BIGINT, "
    "revenue DECIMAL(20,2), n_prices BIGINT, rating BIGINT, n_ratings BIGINT, n_returned BIGINT, n_discounted BIGINT"
)


def additive_parts() -> list[Column]:
    """Aggregates of staged rows from which the mart follows by addition, but for distinct orders."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum("total_price").cast("decimal(20,2)").alias("revenue"),
        F.count("total_price").alias("n_prices"),
        F.sum(F.col("valid_rating").cast("bigint")).alias("rating"),
        F.count("valid_rating").alias("n_ratings"),
        F.count_if("is_returned").alias("n_returned"),
        F.count_if("has_discount").alias("n_discounted"),
    ]


def added_parts(parts: DataFrame) -> DataFrame:
    """One row a group: the sums of its parts."""
    names = [f.strip().split(" ")[0] for f in PARTS_SCHEMA.replace("DECIMAL(20,2)", "DECIMAL").split(",")][len(GROUP) :]
    sums = [F.sum(c).cast("decimal(20,2)" if c == "revenue" else "bigint").alias(c) for c in names]
    return parts.groupBy(*GROUP).agg(*sums)


def mart_of_parts(parts: DataFrame) -> DataFrame:
    """The daily mart from the parts of its groups, any number a group; equals ``daily_mart`` of the rows."""

    def mean(total: str, count: str, kind: str) -> Column:
        value = F.when(F.col(count) > 0, F.round(F.col(total).cast(kind) / F.col(count), 2))
        return value.cast("double")

    return added_parts(parts).select(
        *GROUP,
        F.col("n_rows").alias("total_orders"),
        F.col("n_orders").alias("unique_orders"),
        F.col("quantity").alias("total_quantity"),
        F.col("revenue").alias("total_revenue"),
        mean("revenue", "n_prices", "decimal(20,2)").alias("avg_order_value"),
        mean("rating", "n_ratings", "decimal(20,0)").alias("avg_rating"),
        F.col("n_returned").alias("returned_orders"),
        F.round((F.col("n_returned") * 100).cast("decimal(20,0)") / F.col("n_rows"), 2).cast("double").alias("return_rate_pct"),
        F.col("n_discounted").alias("discounted_orders"),
    )
