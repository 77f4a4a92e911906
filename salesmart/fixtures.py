"""Sales, change records and movie documents made from the test tables.

They stand in for the sources of the jobs: sales come from the order lines and
their dimensions, movies from ``documents``, ``labels`` and ``part``. Every row
of the tables is used.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.binary import encode_decimal
from salesmart.functions.documents import json_text
from salesmart.functions.times import to_epoch_micros
from salesmart.functions.values import discounted_total, is_positive
from salesmart.session import stored_bytes

# Which change operation an order priority stands for.
OPERATIONS = {
    "1-URGENT": "c",
    "2-HIGH": "c",
    "3-MEDIUM": "r",
    "4-NOT SPECIFIED": "u",
    "5-LOW": "d",
}
# The columns from which a sale follows.
SALES_SOURCES = (
    "l_orderkey", "l_linenumber", "l_partkey", "quantity", "price", "discount", "l_returnflag", "l_shipdate",
    "p_name", "p_type", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "r_name", "n_name", "c_mktsegment",
)
# Order lines, in bytes of their table, that are joined at a time where a run spares disk; and how often at most.
SHARE_BYTES, MOST_SHARES = 16 << 20, 8
FIRST_LOAD_DATE = "2026-03-15"
# Items a conversation can list, so that ids of two never meet.
LINES_PER_LISTING = 65536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return amount.cast("decimal(12,2)")


def sales(spark: SparkSession, sf_dir: str, by_day: bool = False, share: tuple[int, int] | None = None) -> DataFrame:
    """Sales with their change operation, booked on the day they were shipped.

    The small tables are joined to the orders first, so the order lines, by far
    the largest table, are shuffled for two joins only. With ``by_day`` the rows of a
    day are brought together, for a write by day, before the columns that follow from
    others make them wider. ``share`` takes the sales of a share of the orders only:
    which one, of how many.
    """

    def shared(rows: DataFrame, order: str) -> DataFrame:
        return rows.filter(F.pmod(F.xxhash64(F.col(order).cast("long")), F.lit(share[1])) == share[0]) if share else rows

    operation = F.create_map(*[F.lit(v) for pair in OPERATIONS.items() for v in pair])
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = shared(table(spark, sf_dir, "orders"), "o_orderkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        shared(table(spark, sf_dir, "lineitem"), "l_orderkey")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    # Amounts are converted before the rows of a day are brought together.
    lines = lines.withColumns(
        {
            "quantity": F.col("l_quantity").cast("int"),
            "price": cents(F.col("l_extendedprice")).cast("decimal(10,2)"),
            "discount": F.round(F.col("l_discount") * 100).cast("int"),
        }
    )
    if by_day:
        lines = lines.select(*SALES_SOURCES, F.to_date("l_shipdate").alias("day")).hint("rebalance", "day")
    discount, price = F.col("discount"), F.col("price")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("ORD-"), F.col("l_orderkey")).alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        "quantity",
        price.alias("unit_price"),
        discount.alias("discount_pct"),
        discounted_total(price, F.lit(1), discount, 10).alias("total_price"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("payment_method"),
        F.col("o_orderstatus").alias("channel"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
        F.col("l_linenumber").alias("rating"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        operation[F.col("o_orderpriority")].alias("cdc_op"),
        F.col("o_orderdate").cast("timestamp").alias("cdc_ts"),
    )


def sales_by_shares(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """All sales, a share of the orders at a time, so that no shuffle holds all order lines."""
    wanted = -(-stored_bytes(spark, f"{sf_dir}/lineitem.parquet") // SHARE_BYTES)
    number = max(1, min(wanted, MOST_SHARES))
    for this in range(number):
        yield sales(spark, sf_dir, share=(this, number) if number > 1 else None)


def lake_rows(rows: DataFrame) -> DataFrame:
    """Sales in the shape of the lake, without the detour over change records."""
    return rows.withColumns(
        {
            "event_date": F.to_date("event_time"),
            "ingest_ts": F.col("cdc_ts"),
            "has_discount": is_positive(F.col("discount_pct")),
        }
    )


def change_records(rows: DataFrame, *extra: str) -> DataFrame:
    """Sales as change records: bare envelopes for channel F, wrapped ones for the others.

    Updates and deletes carry the row before the change, deletes nothing after it.
    """
    image = F.struct(
        *[
            encode_decimal(F.col(c)).alias(c) if c in ("unit_price", "total_price") else F.col(c)
            for c in rows.columns
            if c not in ("event_time", "cdc_op", "cdc_ts")
        ],
        to_epoch_micros(F.col("event_time")).alias("created_at"),
    )
    envelope = F.struct(
        F.when(F.col("cdc_op").isin("u", "d"), image).alias("before"),
        F.when(F.col("cdc_op") != "d", image).alias("after"),
        F.col("cdc_op").alias("op"),
        F.unix_millis("cdc_ts").alias("ts_ms"),
    )
    keep_nulls = {"ignoreNullFields": "false"}
    text = F.when(F.col("channel") == "F", F.to_json(envelope, keep_nulls)).otherwise(
        F.to_json(F.struct(envelope.alias("payload")), keep_nulls)
    )
    return rows.select(text.cast("binary").alias("value"), F.col("cdc_ts").alias("timestamp"), *extra)


def load_date_of(number: Column) -> Column:
    return F.date_add(F.lit(FIRST_LOAD_DATE).cast("date"), number.cast("int"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the date they were loaded on: one date per source."""
    number = F.regexp_extract("source", "[0-9]+", 0)
    return table(spark, sf_dir, "documents").withColumn("load_date", load_date_of(number))


def raw_rows(df: DataFrame, key: str, payload: Column) -> DataFrame:
    """A raw table: key columns and a JSON document, fetched at eight in the morning."""
    return df.select(
        F.col(key).alias("id"),
        "load_date",
        F.col(key).alias("movie_id"),
        payload.alias("payload"),
        (F.col("load_date").cast("timestamp") + F.expr("INTERVAL 8 HOURS")).alias("ingested_at"),
    )


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as listed movies; French ones have no release date."""
    payload = json_text(
        F.col("doc_id").alias("id"),
        F.concat("source", F.lit("/"), "doc_id").alias("title"),
        F.col("source").alias("original_title"),
        F.col("lang").alias("original_language"),
        F.col("text").alias("overview"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("load_date").cast("string")).alias("release_date"),
        (F.col("n_chars") / 8).alias("popularity"),
        F.when(F.col("lang") == "de", "").otherwise(F.col("n_chars").cast("string")).alias("vote_average"),
        F.col("n_chars").alias("vote_count"),
        (F.col("lang") == "en").alias("adult"),
        F.lit(None).cast("boolean").alias("video"),
        F.array(F.col("doc_id"), F.col("n_chars")).alias("genre_ids"),
    )
    return raw_rows(documents(spark, sf_dir), "doc_id", payload)


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as details of the listed movies."""
    rows = documents(spark, sf_dir).select("doc_id", "load_date").join(table(spark, sf_dir, "labels"), "doc_id")
    payload = json_text(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("runtime"),
        (F.col("doc_id") * 1000).alias("budget"),
        F.when(F.col("toxic") == 1, "").otherwise((F.col("doc_id") * 30).cast("string")).alias("revenue"),
    )
    return raw_rows(rows, "doc_id", payload)


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as movie details with sub-documents; the size gives the load date."""
    payload = json_text(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.upper("p_name").alias("original_title"),
        F.lower("p_type").alias("original_language"),
        F.concat("p_name", F.lit(' "'), "p_brand", F.lit('"\n'), "p_type").alias("overview"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("tagline"),
        F.col("p_type").alias("status"),
        F.lit("").alias("homepage"),
        F.concat(F.lit("tt"), "p_partkey").alias("imdb_id"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("load_date").cast("string")).alias("release_date"),
        F.col("p_size").alias("runtime"),
        (F.col("p_partkey") * 1000).alias("budget"),
        F.when(F.col("p_type") == "LARGE", "").otherwise(F.col("p_partkey").cast("string")).alias("revenue"),
        F.col("p_retailprice").alias("popularity"),
        (F.col("p_size") / 4).alias("vote_average"),
        F.col("p_size").alias("vote_count"),
        (F.col("p_type") == "ECONOMY").alias("adult"),
        F.when(F.col("p_type") == "MEDIUM", "").otherwise("true").alias("video"),
        F.concat(F.lit("/"), "p_partkey", F.lit(".jpg")).alias("poster_path"),
        F.array(F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("name"))).alias("genres"),
        F.array(F.struct(F.col("p_brand").alias("name"))).alias("production_companies"),
        F.array().cast("array<string>").alias("production_countries"),
        F.struct(F.col("p_name").alias("name")).alias("spoken_languages"),
    )
    parts = table(spark, sf_dir, "part").withColumn("load_date", load_date_of(F.col("p_size")))
    return raw_rows(parts, "p_partkey", payload)


def page_body(text: Column, listed: Column) -> Column:
    """A result page with one item per line of text; without the array where ``listed`` is false."""
    items = F.transform(
        F.split(text, "\n", -1),
        lambda line, i: F.struct((i + 1).cast("int").alias("line_no"), line.alias("line")),
    )
    return F.when(listed, F.to_json(F.struct(items.alias("results")))).otherwise(F.lit('{"page": 1}'))


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation as a page; the system's turns list nothing."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv-"), "conv_id").alias("listing"),
        (F.col("turn") + 1).alias("page"),
        page_body(F.col("text"), F.col("role") != "system").alias("body"),
    )


def dated_conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a page; conversations share the load dates of a year, and an item's id
    is its conversation and line."""
    items = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct((F.col("conv_id") * LINES_PER_LISTING + i + 1).alias("id"), line.alias("line")),
    )
    return table(spark, sf_dir, "conversations").select(
        load_date_of(F.pmod("conv_id", F.lit(365))).alias("load_date"),
        F.col("turn").alias("page"),
        F.to_json(F.struct(items.alias("results"))).alias("body"),
    )


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), "doc_id").alias("listing"),
        F.lit(1).cast("bigint").alias("page"),
        page_body(F.col("text"), F.lit(True)).alias("body"),
    )
