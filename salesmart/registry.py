"""The registered queries: every operator, run over the whole test tables.

Dates and times come out as text (``plain``), so that another engine's result
compares without guessing at types; decimals stay what they are.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from salesmart import fixtures as fx
from salesmart.functions.binary import decode_decimal, encode_decimal
from salesmart.functions.documents import json_text, text_fields, typed, variant_text
from salesmart.functions.times import (
    from_epoch_micros,
    from_epoch_millis,
    next_day,
    second_text,
    to_epoch_micros,
    weekday_from_monday,
)
from salesmart.functions.values import discounted_total, is_positive, row_key
from salesmart.operators import audit, keys, loads, pages, published, quality, retention, slices, tables
from salesmart.plans import movies
from salesmart.plans import sales as model
from salesmart.operators.swaps import move_files
from salesmart.session import remove_folder, sparing_disk, use_settings, working_folder
from salesmart.sources.kafka import POSITION_SCHEMA, RECORD_SCHEMA, recorded_changes
from salesmart.sources.lake import BATCH, read_dataset, read_day, write_batch, write_dataset
from salesmart.streaming import offsets
from salesmart.streaming.deltas import read_delta_mart, start_delta_mart_stream
from salesmart.streaming.lake import start_lake_stream
from salesmart.streaming.once import CHANGE_KEY, landed_once

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values the queries and their SQL share.
LAKE_DAY = dt.date(1998, 4, 1)
LAKE_AS_OF = dt.datetime(1998, 6, 15, 12)
COMPACTED_DAYS = [dt.date(1998, 6, 1), dt.date(1998, 6, 2)]
ARRIVALS = (dt.datetime(1994, 1, 1), dt.datetime(1996, 1, 1))
# Of each thousand offsets, those that are lost; and the offsets read before and after a restart.
LOST_OFFSETS = (200, 209)
READ_TWICE = (100, 149)
# Ids whose records are put in order in one task.
ID_STRETCH = 1_000_000
REPLACED_DATE = dt.date(2026, 3, 20)
FIRST_DATE = dt.date(2026, 3, 15)
AS_OF = dt.datetime(2024, 2, 15)
DOCUMENT_KEY = ("load_date", "doc_id")

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text."""

    def column(field):
        value = F.col(field.name)
        if isinstance(field.dataType, DateType):
            return value.cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return value

    return df.select(*[column(f) for f in df.schema.fields])


# What each query made in its last run: its result reads it, so it goes with the next run.
_made: dict[tuple[str, str], list[Callable[[], object]]] = {}
_running: list[Callable[[], object]] = []


def scratch(spark: SparkSession, purpose: str) -> str:
    """A working folder of the running query."""
    path = working_folder(spark, purpose)
    _running.append(lambda: remove_folder(spark, path))
    return path


def scratch_database(spark: SparkSession, purpose: str) -> str:
    """A database of the running query, in a working folder of its own."""
    folder = scratch(spark, purpose)
    database = folder.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    _running.insert(0, lambda: spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE"))
    return database


def scratch_table(spark: SparkSession, purpose: str) -> str:
    """The name for a table of the running query."""
    name = f"{purpose}_{uuid.uuid4().hex}"
    _running.insert(0, lambda: tables.drop_table(spark, name))
    return name


def drop_made(spark: SparkSession, name: str) -> None:
    """Remove the tables, databases and folders a query's last run left for its result."""
    for drop in _made.pop((spark.sparkContext.applicationId, name), []):
        drop()


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        drop_made(spark, build.__name__)
        _running.clear()
        result = plain(build(use_settings(spark), sf_dir))
        _made[spark.sparkContext.applicationId, build.__name__] = list(_running)
        return result

    QUERIES[build.__name__] = run
    return build


# Change records -------------------------------------------------------------


@query
def cdc_payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operation and first image out of bare and wrapped envelopes, of every operation."""
    events = model.parse_changes(fx.change_records(fx.sales(spark, sf_dir)))
    after = F.col("event.after")
    return events.select(
        F.col("event.op").alias("op"),
        after["id"].alias("id"),
        after["order_id"].alias("order_id"),
        "ingest_ts",
    )


@query
def cdc_decode_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.decode_changes(fx.change_records(fx.sales(spark, sf_dir)))


@query
def cdc_decimal_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    def amounts(table: str, key: str, amount: str) -> DataFrame:
        encoded = encode_decimal(fx.cents(F.col(amount)))
        return fx.table(spark, sf_dir, table).select(
            F.lit(table).alias("kind"), F.col(key).alias("key"), encoded.alias("encoded")
        )

    both = amounts("orders", "o_orderkey", "o_totalprice").unionByName(
        amounts("customer", "c_custkey", "c_acctbal")
    )
    return both.select("kind", "key", decode_decimal(F.col("encoded")).alias("amount"))


@query
def cdc_op_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sales(spark, sf_dir)
    keyless = rows.withColumn("id", F.when(~F.col("is_returned"), F.col("id")))
    kept = model.first_images(model.parse_changes(fx.change_records(keyless)))
    return kept.groupBy("op").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def epoch_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = fx.table(spark, sf_dir, "events").select("event_id", to_epoch_micros(F.col("ts")).alias("micros"))
    moment = from_epoch_micros(F.col("micros"))
    return micros.select(
        "event_id",
        moment.alias("event_ts"),
        from_epoch_millis(F.expr("micros div 1000")).alias("event_ts_millis"),
        second_text(moment).alias("event_time"),
        F.to_date(moment).alias("event_date"),
        next_day(F.to_date(moment)).alias("next_date"),
        weekday_from_monday(moment).alias("weekday"),
    )


@query
def discount_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.when(F.col("l_linestatus") == "O", F.round(F.col("l_discount") * 100).cast("int"))
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", is_positive(discount).alias("has_discount")
    )


@query
def price_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem").join(
        fx.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    # Half a piece and half a percent more, so that both have fractions.
    discount = F.round(F.col("l_discount") * 100).cast("int") + F.expr("0.5")
    total = discounted_total(F.col("p_retailprice"), F.col("l_quantity") + F.expr("0.5"), discount)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", total.alias("total_price"))


# Lake -----------------------------------------------------------------------


def sales_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake of all sales, written for the running query."""
    path = scratch(spark, "lake")
    write_batch(fx.lake_rows(fx.sales(spark, sf_dir, by_day=True)), path, "all", spread=False)
    return path


@query
def lake_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_day(spark, sales_lake(spark, sf_dir), LAKE_DAY, model.LAKE_SCHEMA)


def replayed_lake(spark: SparkSession, records: str, lake: str, checkpoint: str) -> None:
    """Run the lake stream over what lies in ``records`` and stop."""
    rows = model.decode_changes(recorded_changes(spark, records))
    start_lake_stream(rows, lake, checkpoint, every=None).awaitTermination()


def deliver(spark: SparkSession, parts: list[str], records: str, schema: str = RECORD_SCHEMA) -> None:
    """Let the files of records in these folders arrive where a stream reads. If there are none,
    a file without rows does, so that the stream still makes its first batch."""
    if not sum(move_files(spark, part, records) for part in parts):
        spark.createDataFrame([], schema).write.mode("append").parquet(records)


@query
def stream_cdc_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "stream")
    fx.change_records(fx.sales(spark, sf_dir)).write.parquet(f"{folder}/records")
    replayed_lake(spark, f"{folder}/records", f"{folder}/lake", f"{folder}/checkpoint")
    return read_dataset(spark, f"{folder}/lake", model.LAKE_SCHEMA)


@query
def lake_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, a backfill of the updates, retention and compaction, all on one lake."""
    folder = scratch(spark, "lifecycle")
    lake = f"{folder}/lake"
    sales = fx.sales(spark, sf_dir)
    fx.change_records(sales).write.parquet(f"{folder}/records")
    replayed_lake(spark, f"{folder}/records", lake, f"{folder}/checkpoint")
    write_batch(fx.lake_rows(sales).filter(F.col("cdc_op") == "u"), lake, "backfill")
    schema = StructType.fromDDL(f"{model.LAKE_SCHEMA}, {BATCH} STRING")
    loads.expire_rows(spark, lake, schema, "event_time", LAKE_AS_OF, further=[BATCH])
    loads.compact_days(spark, lake, StructType.fromDDL(model.LAKE_SCHEMA), COMPACTED_DAYS)
    return read_dataset(spark, lake, model.LAKE_SCHEMA)


def day_table(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], object], days: list) -> DataFrame:
    """A table into which the given days of the lake are loaded one after another."""
    lake, warehouse = sales_lake(spark, sf_dir), scratch(spark, "day-load")
    schema = StructType.fromDDL(model.LAKE_SCHEMA)
    for day in days:
        loads.load_day(spark, lake, schema, day, lambda rows, day=day: write(rows, warehouse, day))
    return read_dataset(spark, warehouse, model.LAKE_SCHEMA)


@query
def day_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run replaces what the first one loaded."""
    return day_table(
        spark, sf_dir, lambda rows, path, day: loads.replace_date(rows, path, day, "event_date"), [LAKE_DAY, LAKE_DAY]
    )


@query
def day_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days appended to one table."""
    return day_table(spark, sf_dir, loads.append_day, [LAKE_DAY, LAKE_DAY + dt.timedelta(days=1)])


# Sales models ---------------------------------------------------------------


@query
def stg_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.lake_rows(fx.sales(spark, sf_dir)).createOrReplaceTempView("raw_sales_events")
    return model.staged_sales(spark.table("raw_sales_events"))


@query
def stg_sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging layer as a catalog view over the raw table."""
    database = scratch_database(spark, "layers")
    raw, view = f"{database}.raw_sales_events", f"{database}.stg_sales_events"
    tables.create_table(spark, raw, model.LAKE_SCHEMA)
    tables.append_rows(fx.lake_rows(fx.sales(spark, sf_dir)), raw)
    model.create_staged_view(spark, view, raw)
    return spark.table(view)


@query
def mart_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = model.staged_sales(fx.lake_rows(fx.sales(spark, sf_dir)))
    return model.daily_mart(staged, ordered=True)


@query
def mart_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row of a day in the mart's order."""
    mart = model.daily_mart(model.staged_sales(fx.lake_rows(fx.sales(spark, sf_dir))))
    place = F.rank().over(Window.partitionBy("event_date").orderBy(F.desc("total_revenue")))
    return mart.select("event_date", "region", "category", "total_revenue", place.alias("place"))


@query
def mart_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart over decoded change records: decode, stage and aggregate as one plan."""
    rows = model.decode_changes(fx.change_records(fx.sales(spark, sf_dir)))
    return model.daily_mart(model.staged_sales(rows))


@query
def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records arrive in three ranges of dates, the seventh lines of the first range with
    the last; both streams restart after each arrival."""
    folder = scratch(spark, "incremental")
    first, second = (F.col("event_time") < F.lit(day) for day in ARRIVALS)
    late = F.col("rating") == 7
    sales = fx.sales(spark, sf_dir).withColumn(
        "arrival", F.when(first & ~late, 1).when(second & ~first, 2).otherwise(3)
    )
    fx.change_records(sales, "arrival").write.partitionBy("arrival").parquet(f"{folder}/all")
    for arrival in (1, 2, 3):
        deliver(spark, [f"{folder}/all/arrival={arrival}"], f"{folder}/records")
        replayed_lake(spark, f"{folder}/records", f"{folder}/lake", f"{folder}/lake-checkpoint")
        start_delta_mart_stream(
            spark, f"{folder}/lake", f"{folder}/mart", f"{folder}/mart-checkpoint", every=None
        ).awaitTermination()
    return read_delta_mart(spark, f"{folder}/mart")


def placed_sales(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """Sales in pieces, with the partition and the offset that they get in the order of their ids.

    Offsets are counted within stretches of ids, and go on from the rows of the stretches before.
    """
    place = ["partition", "stretch"]
    key = F.col("id") - F.col("id") % 10
    to = {"partition": (key / 10 % 16).cast("int"), "stretch": F.floor(F.col("id") / ID_STRETCH)}
    for sales in fx.sales_by_shares(spark, sf_dir):
        sales = sales.withColumns(to)
        slices.write_slices(sales, f"{folder}/placed", place)
    columns, placed = sales.columns, slices.read_slices(spark, f"{folder}/placed", sales.schema)
    before = Window.partitionBy("partition").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("n_rows"))
    starts = counts.select(*place, F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"))
    with sparing_disk(spark):
        slices.write_slices(starts, f"{folder}/starts", place)
    starts = slices.read_slices(spark, f"{folder}/starts", starts.schema)
    # The start of a stretch goes through the same shuffle as its rows, before all of them.
    stretch = Window.partitionBy(*place).orderBy(F.col("start").isNull(), "id")
    first = F.first("start").over(stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for share in slices.shares(spark, f"{folder}/placed"):
        some, begin = (rows.filter(F.col(slices.SLICE).isin(share)).drop(slices.SLICE) for rows in (placed, starts))
        both = some.withColumn("start", F.lit(None).cast("long")).unionByName(begin, True)
        offset = first + F.row_number().over(stretch) - 2
        numbered = both.withColumn("offset", offset.cast("long")).filter(F.col("start").isNull())
        yield numbered.select(*[c for c in columns if c != "stretch"], "offset")


@query
def offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets that a topic lost, and those that were read again after a restart further back."""
    folder = scratch(spark, "offsets")
    low, high = READ_TWICE
    read = F.when(F.col("offset") < low, "first").when(F.col("offset") <= high, "twice").otherwise("second")
    for placed in placed_sales(spark, sf_dir, folder):
        records = fx.change_records(placed.withColumn("topic", F.lit("sales")), "topic", "partition", "offset")
        kept = records.filter(~(F.col("offset") % 1000).between(*LOST_OFFSETS))
        with sparing_disk(spark, writers=3):
            kept.withColumn("read", read).write.mode("append").partitionBy("read").parquet(f"{folder}/all")
    schema = f"{RECORD_SCHEMA}, {POSITION_SCHEMA}"
    twice = read_dataset(spark, f"{folder}/all", f"{schema}, read STRING").filter(F.col("read") == "twice")
    twice.drop("read").write.parquet(f"{folder}/again")
    for delivered in (["all/read=first", "all/read=twice"], ["again", "all/read=second"]):
        deliver(spark, [f"{folder}/{part}" for part in delivered], f"{folder}/records", schema)
        start_lake_stream(
            recorded_changes(spark, f"{folder}/records", positions=True),
            f"{folder}/lake",
            f"{folder}/checkpoint",
            ["region"],
            every=None,
            # Few regions: a task's rows fill files of each, and a shuffle is spared.
            spread=False,
            prepare=offsets.tracked(model.decode_changes, f"{folder}/ledger"),
        ).awaitTermination()
    return offsets.offset_report(spark, f"{folder}/ledger")


@query
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of which those of the first four lines of an order are delivered again.
    Some lines share their number, so the product is part of the key."""
    folder = scratch(spark, "once")
    read = F.when(F.col("rating") <= 4, "twice").otherwise("once")
    for sales in fx.sales_by_shares(spark, sf_dir):
        records = fx.change_records(sales.withColumn("read", read), "read")
        with sparing_disk(spark, writers=2):
            records.write.mode("append").partitionBy("read").parquet(f"{folder}/all")
    # Under new names, files are new to the stream: their records come again.
    for delivered in (["all/read=twice"], ["records", "all/read=once"]):
        deliver(spark, [f"{folder}/{part}" for part in delivered], f"{folder}/records")
        start_lake_stream(
            recorded_changes(spark, f"{folder}/records"),
            f"{folder}/lake",
            f"{folder}/checkpoint",
            ["region"],
            every=None,
            # Few regions: a task's rows fill files of each, and a shuffle is spared.
            spread=False,
            prepare=landed_once(f"{folder}/keys", [*CHANGE_KEY, "product_id"], decode=model.decode_changes),
        ).awaitTermination()
    return read_dataset(spark, f"{folder}/lake", model.LAKE_SCHEMA)


# JSON documents -------------------------------------------------------------


@query
def json_stage_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies.stage_listing(fx.raw_listing(spark, sf_dir)).drop("raw_payload")


@query
def stage_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load date of the raw documents."""
    return movies.stage_listing(fx.raw_listing(spark, sf_dir), REPLACED_DATE).select(
        "raw_id", *movies.MOVIE_KEY, "title", "popularity"
    )


@query
def json_stage_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies.stage_details(fx.raw_parts(spark, sf_dir)).drop("raw_payload")


def landed_variants(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Raw documents that were parsed as they landed, by load date."""
    parsed, path = movies.parsed_once(raw), scratch(spark, "variants")
    write_dataset(parsed, path, ["load_date"])
    return read_dataset(spark, path, loads.table_schema(parsed, ["load_date"]))


@query
def variant_stage_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies.stage_listing(landed_variants(spark, fx.raw_listing(spark, sf_dir))).drop("raw_payload")


@query
def variant_stage_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies.stage_details(landed_variants(spark, fx.raw_parts(spark, sf_dir))).drop("raw_payload")


@query
def variant_pages_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows of ``pages_to_raw``, with the items of a page as VARIANT."""
    listed = movies.listed_in_pages(fx.dated_conversation_pages(spark, sf_dir), as_variant=True)
    raw = movies.as_raw(listed, F.col("load_date").cast("timestamp"))
    return raw.select("id", *movies.MOVIE_KEY, variant_text(F.col("document"), "line").alias("line"))


@query
def nullif_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    def unless(condition, value):
        return F.when(condition, "").otherwise(value.cast("string"))

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    payloads = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        json_text(
            unless(status == "P", F.to_date("o_orderdate")).alias("day"),
            unless(priority == "1-URGENT", fx.cents(F.col("o_totalprice"))).alias("amount"),
            unless(priority == "2-HIGH", F.col("o_custkey")).alias("customer"),
            unless(status == "O", status == "F").alias("finished"),
        ).alias("payload"),
    )
    kinds = {"day": "date", "amount": movies.NUMBER, "customer": "bigint", "finished": "boolean"}
    parsed = payloads.withColumn("parsed", text_fields(F.col("payload"), list(kinds)))
    return parsed.select(
        "o_orderkey", *[typed(F.col(f"parsed.{name}"), kind).alias(name) for name, kind in kinds.items()]
    )


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = fx.documents(spark, sf_dir)
    return keyed.select("doc_id", row_key("load_date", "doc_id").alias("row_key"))


@query
def mart_movies_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = movies.stage_listing(fx.raw_listing(spark, sf_dir))
    details = movies.stage_details(fx.raw_labels(spark, sf_dir))
    return movies.mart_from_listing(listing, details)


@query
def mart_movies_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies.mart_from_details(movies.stage_details(fx.raw_parts(spark, sf_dir), with_row_key=False))


@query
def enrich_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus"
    )
    details = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return keys.enriched(listing, details, ["c_custkey"])


@query
def ingest_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as fetched details, each twice, of which the second counts; only those of documents
    that a page lists."""
    documents = fx.documents(spark, sf_dir)
    page = F.to_json(F.struct(F.array(F.struct(F.col("doc_id").alias("id"))).alias("results")))
    listed = movies.listed_in_pages(
        documents.filter(F.col("lang") != "en").select("load_date", F.lit(1).alias("page"), page.alias("body"))
    )
    found = documents.join(fx.table(spark, sf_dir, "labels"), "doc_id")

    def fetched(hour: int, quality: Column) -> DataFrame:
        body = json_text(F.col("doc_id").alias("id"), quality.alias("runtime"))
        at = F.col("load_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(hour))
        return found.select("load_date", at.alias("fetched_at"), body.alias("body"))

    details = fetched(9, F.col("quality") + 10).unionByName(fetched(8, F.lit(99)))
    landed = movies.listed_details(details, listed)
    return landed.select(*movies.MOVIE_KEY, F.get_json_object("payload", "$.runtime").cast("int").alias("runtime"))


@query
def land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer")
    landed = movies.land_documents(customers, F.lit(FIRST_DATE), key="c_custkey")
    parsed = F.from_json("payload", customers.schema)
    return landed.select("load_date", "movie_id", parsed.alias("row")).select("load_date", "movie_id", "row.*")


@query
def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of every conversation, and whether the page is one of the first two."""
    found = fx.conversation_pages(spark, sf_dir)
    kind = "STRUCT<line_no: INT, line: STRING>"
    capped = pages.flatten_pages(found, kind, max_pages=2).select("listing", "page").distinct()
    items = pages.flatten_pages(found, kind).join(capped.withColumn("in_cap", F.lit(True)), ["listing", "page"], "left")
    return items.select("listing", "page", "item.*", F.coalesce("in_cap", F.lit(False)).alias("in_cap"))


@query
def flatten_all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of two listings as one set."""
    found = pages.union_pages(fx.conversation_pages(spark, sf_dir), fx.document_pages(spark, sf_dir))
    items = pages.flatten_pages(found, "STRUCT<line_no: INT, line: STRING>")
    return items.select("listing", "page", "item.*")


@query
def pages_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn is a page, a line of a conversation a movie; the last line of a number wins."""
    listed = movies.listed_in_pages(fx.dated_conversation_pages(spark, sf_dir))
    raw = movies.as_raw(listed, F.col("load_date").cast("timestamp"))
    return raw.select("id", *movies.MOVIE_KEY, F.get_json_object("payload", "$.line").alias("line"))


# Load modes -----------------------------------------------------------------


@query
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]
    last = keys.last_per_key(lines, ["l_orderkey", "l_linenumber"], order)
    return last.select("l_orderkey", "l_linenumber", *order)


def document_rows(spark: SparkSession, sf_dir: str, origin: str, factor: int = 1) -> DataFrame:
    return fx.documents(spark, sf_dir).select(
        "doc_id", "lang", (F.col("n_chars") * factor).alias("n_chars"), F.lit(origin).alias("origin"), "load_date"
    )


def labelled_table(spark: SparkSession, sf_dir: str) -> str:
    """A table that holds the labelled documents already."""
    path = scratch(spark, "documents")
    labelled = document_rows(spark, sf_dir, "old").join(fx.table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    write_dataset(labelled, path, ["load_date"])
    return path


DOCUMENT_TABLE = "doc_id BIGINT, lang STRING, n_chars BIGINT, origin STRING, load_date DATE"


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = labelled_table(spark, sf_dir)
    for _ in range(2):  # the second run finds every key
        loads.insert_if_absent(document_rows(spark, sf_dir, "new", 2), path, DOCUMENT_KEY)
    return read_dataset(spark, path, DOCUMENT_TABLE)


@query
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = labelled_table(spark, sf_dir)
    batch = document_rows(spark, sf_dir, "new", 2).filter(F.col("lang") == "en")
    for _ in range(2):  # the second run changes nothing
        loads.upsert_by_key(batch, path, DOCUMENT_KEY)
    return read_dataset(spark, path, DOCUMENT_TABLE)


@query
def upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents come a day later than the table has them; an index of the key tells
    which dates to rewrite."""
    path, index = labelled_table(spark, sf_dir), scratch(spark, "key-dates")
    batch = document_rows(spark, sf_dir, "new", 2).filter(F.col("lang") == "en")
    batch = batch.withColumn("load_date", F.date_add("load_date", 1))
    for _ in range(2):  # the second run changes nothing
        loads.upsert_by_key(batch, path, ["doc_id"], index=index, buckets=16)
    return read_dataset(spark, path, DOCUMENT_TABLE)


@query
def replace_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is also split by language, and the new batch lacks some of them."""
    path = scratch(spark, "documents")
    write_dataset(document_rows(spark, sf_dir, "old"), path, ["load_date", "lang"])
    batch = document_rows(spark, sf_dir, "new", 2).filter(F.col("lang") == "en")
    loads.replace_date(batch, path, REPLACED_DATE, partition_by=["lang"])
    schema = "doc_id BIGINT, n_chars BIGINT, origin STRING, load_date DATE, lang STRING"
    return read_dataset(spark, path, schema)


@query
def load_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "together")
    listing = fx.raw_listing(spark, sf_dir).select("movie_id", "payload", "load_date")
    details = fx.raw_labels(spark, sf_dir).select("movie_id", "payload", "load_date")
    loads.load_together({f"{folder}/listing": listing, f"{folder}/details": details}, movies.MOVIE_KEY)
    schema = "movie_id BIGINT, payload STRING, load_date DATE"
    return pages.union_pages(
        *[
            read_dataset(spark, f"{folder}/{name}", schema).select(
                F.lit(name).alias("kind"),
                *movies.MOVIE_KEY,
                F.get_json_object("payload", "$.id").cast("bigint").alias("payload_id"),
            )
            for name in ("listing", "details")
        ]
    )


@query
def load_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels loaded by language, of which the French load is withdrawn and the
    German one wrote one table only."""
    folder = scratch(spark, "published")
    tables_of = {"documents": fx.documents(spark, sf_dir).select("doc_id", "lang", "load_date")}
    tables_of["labels"] = tables_of["documents"].join(fx.table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    register, schema = f"{folder}/register", "doc_id BIGINT, lang STRING, load_date DATE"
    for lang in ("en", "es", "fr", "en"):  # the second load of a name changes nothing
        batches = {f"{folder}/{name}": rows.filter(F.col("lang") == lang) for name, rows in tables_of.items()}
        published.load_published(batches, register, lang)
    published.withdraw(spark, register, "fr")
    german = tables_of["documents"].filter(F.col("lang") == "de")
    write_dataset(german, f"{folder}/documents/{published.LOAD}=de", ["load_date"])
    return pages.union_pages(
        *[
            published.read_published(spark, f"{folder}/{name}", schema, register, with_load=True).withColumn("kind", F.lit(name))
            for name in tables_of
        ]
    )


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = fx.documents(spark, sf_dir)
    return audit.load_audit(listing, fx.table(spark, sf_dir, "labels"), ["doc_id"], "load_date")


@query
def load_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date after three finished ones, of which the second had no rows."""
    source = document_rows(spark, sf_dir, "source").filter(F.col("load_date") != F.lit(FIRST_DATE + dt.timedelta(days=1)))
    path, state = scratch(spark, "loaded"), scratch(spark, "state")
    for _ in range(3):
        day = audit.next_load_date(spark, state, FIRST_DATE)
        loads.replace_date(audit.rows_to_load(source, state, FIRST_DATE), path, day)
        audit.finish_date(spark, state, day)
    return audit.rows_to_load(source, state, FIRST_DATE)


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of inserts only, rebuilt from all sales."""
    database = scratch_database(spark, "marts")
    name = f"{database}.mart_sales_daily"
    rows = fx.lake_rows(fx.sales(spark, sf_dir))
    for kept in (rows.filter(F.col("cdc_op") == "c"), rows):
        mart = model.daily_mart(model.staged_sales(kept))
        tables.full_refresh(tables.commented(mart, {"event_date": "day of the sale"}), name)
    return spark.table(name)


# Retention, table layout, checks --------------------------------------------


@query
def retention_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = retention.keep_recent(fx.table(spark, sf_dir, "events"), "ts", AS_OF)
    return kept.select("event_id", "ts", "event_type")


@query
def retention_weekends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expired rows go only where they fall on a weekend."""
    weekend = weekday_from_monday(F.col("ts")).isin(6, 7)
    kept = retention.keep_recent(fx.table(spark, sf_dir, "events"), "ts", AS_OF, only_where=weekend)
    return kept.select("event_id", "ts", "event_type")


@query
def retention_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows dropped from a table by date, in the middle of a day."""
    path = scratch(spark, "events")
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("event_date")
    )
    write_dataset(events, path, ["event_date"])
    schema = loads.table_schema(events, ["event_date"])
    loads.expire_rows(spark, path, schema, "ts", AS_OF + dt.timedelta(hours=12))
    return read_dataset(spark, path, schema)


@query
def computed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Economy parts bring their size, the others get the default."""
    name = scratch_table(spark, "computed")
    tables.create_table(
        spark,
        name,
        "p_partkey BIGINT, col_default BIGINT DEFAULT 42 COMMENT 'size or default', col_stored BIGINT",
        location=scratch(spark, "computed"),
    )
    parts = fx.table(spark, sf_dir, "part")
    economy = F.col("p_type") == "ECONOMY"
    default, stored = {"col_default": F.lit(42)}, {"col_stored": F.col("col_default").cast("bigint") * 33}
    given = parts.filter(economy).select("p_partkey", F.col("p_size").alias("col_default"))
    tables.append_rows(tables.with_computed(given, default, stored), name)
    omitted = parts.filter(~economy).select("p_partkey")
    # The default itself is left to the table.
    tables.append_rows(tables.with_computed(omitted, default, stored).drop("col_default"), name)
    return tables.with_computed(spark.table(name), derived={"col_alias": F.col("col_default") + 1})


@query
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of literal rows, one column by default, that orders look up."""
    name = scratch_table(spark, "literal")
    tables.create_table(
        spark, name, "priority STRING, op STRING, weight INT DEFAULT 7", location=scratch(spark, "literal")
    )
    tables.insert_rows(spark, name, list(fx.OPERATIONS.items()), "priority STRING, op STRING")
    orders = fx.table(spark, sf_dir, "orders")
    return orders.join(spark.table(name), F.col("o_orderpriority") == F.col("priority"), "left").select(
        "o_orderkey", "op", "weight"
    )


@query
def column_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments of a stored table's columns, and how many rows have a value there."""
    name = scratch_table(spark, "commented")
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    comments = {"c_custkey": "number of the customer", "c_name": "as on the invoice"}
    path = scratch(spark, "commented")
    tables.commented(customers, comments).write.option("path", path).saveAsTable(name)
    columns = [(c.name, c.description) for c in spark.catalog.listColumns(name)]
    described = spark.createDataFrame(columns, "column_name STRING, remark STRING")
    filled = spark.table(name).agg(*[F.count(c).alias(c) for c in customers.columns])
    return described.join(filled.unpivot([], customers.columns, "column_name", "filled"), "column_name")


@query
def array_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays written to a table, read back and taken apart."""
    path = scratch(spark, "arrays")
    items = F.array(F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("bigint"))
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", items.alias("items"))
    write_dataset(rows, path, partition_by=())
    stored = read_dataset(spark, path, "l_orderkey BIGINT, l_shipdate TIMESTAMP_NTZ, items ARRAY<BIGINT>")
    return stored.select("l_orderkey", "l_shipdate", F.posexplode("items").alias("position", "item"))


@query
def sorted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sorted")
    orders = fx.table(spark, sf_dir, "orders")
    tables.write_sorted(orders, path, ["o_custkey"])
    return read_dataset(spark, path, orders.schema)


@query
def compressed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "compressed")
    orders = fx.table(spark, sf_dir, "orders")
    write_dataset(orders, path, partition_by=(), options=tables.compression("zstd", 10))
    return read_dataset(spark, path, orders.schema)


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = fx.documents(spark, sf_dir).join(fx.table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.null_counts(labelled, ["doc_id", "load_date", "quality", "toxic"])


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_report(
        movies.stage_listing(fx.raw_listing(spark, sf_dir)),
        not_null=["raw_id", "movie_id", "load_date", "release_date"],
        unique=["raw_id", "load_date"],
    )
