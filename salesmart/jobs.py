"""The jobs on the command line, for ``spark-submit``.

    jobs.py stream       change records of a Kafka topic to the lake, until stopped
    jobs.py compact      the batches of closed days of the lake merged
    jobs.py expire       old rows dropped from the lake
    jobs.py load-day     one day of the lake to a database, or to a Parquet table
    jobs.py mart         the daily mart, kept up to date with the lake
    jobs.py merge-month  the parts of a month of a mart that adds up deltas
    jobs.py full-mart    the daily mart rebuilt from the whole lake, as a catalog table
    jobs.py ingest       result pages and details of one load date to the raw tables
    jobs.py stage        one load date of raw movie documents to the staging tables
    jobs.py check        the checks on the staging tables
    jobs.py movies       one load date of the staging tables to the movie mart

Endpoints and credentials of the stores belong to the Spark configuration of the
submit; the database password is read from a file or an environment variable.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.operators.audit import finish_date, next_load_date
from salesmart.operators.loads import (
    append_day,
    compact_days,
    expire_rows,
    load_day,
    load_together,
    open_table,
    replace_date,
    table_schema,
    upsert_by_key,
)
from salesmart.operators.quality import require
from salesmart.operators.tables import full_refresh
from salesmart.plans import movies
from salesmart.plans import sales as model
from salesmart.session import WIDE, build_session
from salesmart.sources.kafka import kafka_changes
from salesmart.sources.lake import BATCH, read_dataset
from salesmart.sources.relational import append_jdbc
from salesmart.streaming.deltas import merge_period, start_delta_mart_stream
from salesmart.streaming.lake import start_lake_stream
from salesmart.streaming.mart import sales_mart, start_mart_stream

RAW_MOVIES = "id BIGINT, movie_id BIGINT, payload STRING, ingested_at TIMESTAMP, load_date DATE"
RAW_VARIANTS = "id BIGINT, movie_id BIGINT, document VARIANT, unparsed STRING, ingested_at TIMESTAMP, load_date DATE"


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    records = kafka_changes(spark, args.servers, args.topic, max_offsets_per_trigger=args.max_offsets)
    rows = model.decode_or_reject(records, observe="changes")
    start_lake_stream(
        rows, args.lake, args.checkpoint, every=args.every, rejects=args.rejects or f"{args.lake}_rejects"
    ).awaitTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = StructType.fromDDL(model.LAKE_SCHEMA)
    days = [args.first + dt.timedelta(days=i) for i in range((args.last - args.first).days + 1)]
    compact_days(spark, args.lake, schema, days)


def expire(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = StructType.fromDDL(f"{model.LAKE_SCHEMA}, {BATCH} STRING")
    as_of = dt.datetime.combine(args.as_of, dt.time())
    days = expire_rows(spark, args.lake, schema, "event_time", as_of, args.months, further=[BATCH])
    print(f"{len(days)} dates changed")


def load_one_day(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = StructType.fromDDL(model.LAKE_SCHEMA)

    def to_database(rows: DataFrame) -> None:
        password = os.environ.get("JDBC_PASSWORD", "")
        if args.password_file:
            password = Path(args.password_file).read_text().strip()
        login = {"user": args.user, "password": password}
        append_jdbc(rows, args.url, args.table, args.driver, login)

    def to_table(rows: DataFrame) -> None:
        if args.append:
            append_day(rows, args.table, args.date)
        else:
            replace_date(rows, args.table, args.date, "event_date")

    rows = load_day(spark, args.lake, schema, args.date, to_database if args.url else to_table)
    print(f"{args.date}: {rows} rows")


def follow_mart(spark: SparkSession, args: argparse.Namespace) -> None:
    every = None if args.once else args.every
    if args.deltas:
        start_delta_mart_stream(spark, args.lake, args.mart, args.checkpoint, every=every).awaitTermination()
        return
    start_mart_stream(spark, args.lake, args.mart, args.checkpoint, every=every).awaitTermination()


def merge_month(spark: SparkSession, args: argparse.Namespace) -> None:
    merge_period(spark, args.mart, args.month.replace(day=1))


def rebuild_mart(spark: SparkSession, args: argparse.Namespace) -> None:
    full_refresh(sales_mart(read_dataset(spark, args.lake, model.LAKE_SCHEMA)), args.name)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages (``load_date, page, body``) and details (``load_date, fetched_at, body``) come as Parquet."""
    pages = read_dataset(spark, args.pages, "load_date DATE, page INT, body STRING")
    counted = Observation("pages")
    found = movies.listed_in_pages(movies.on_date(pages, args.date), args.max_pages, args.lenient, counted, args.variant)
    details = read_dataset(spark, args.details, "load_date DATE, fetched_at TIMESTAMP, body STRING")
    once = movies.listed_details(movies.on_date(details, args.date), found)
    if args.variant:
        once = movies.parsed_once(once, args.lenient)
    now = F.current_timestamp()
    loaded = load_together(
        {
            f"{args.root}/raw/listing": movies.as_raw(found, now),
            f"{args.root}/raw/details": movies.as_raw(once, now),
        },
        movies.MOVIE_KEY,
    )
    print(f"{args.date}: {loaded}, pages {counted.get}")


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    for table in movie_tables(spark, args.root, "stage"):
        require(movies.on_date(table, args.date), movies.STAGE_NOT_NULL, movies.STAGE_UNIQUE)


def movie_tables(spark: SparkSession, root: str, layer: str, raw: str = RAW_MOVIES) -> tuple[DataFrame, DataFrame]:
    """The listing and the details of a layer, empty where nothing was loaded yet."""
    listing = details = spark.createDataFrame([], raw)
    if layer == "stage":
        listing, details = movies.stage_listing(listing), movies.stage_details(details)
    return tuple(
        open_table(spark, f"{root}/{layer}/{name}", table_schema(empty, ["load_date"]), ["load_date"])
        for name, empty in (("listing", listing), ("details", details))
    )


def stage(spark: SparkSession, args: argparse.Namespace) -> None:
    listing, details = movie_tables(spark, args.root, "raw", RAW_VARIANTS if args.variant else RAW_MOVIES)
    state = f"{args.root}/state/staged"
    day = args.date or next_load_date(spark, state, args.first)
    staged = {
        "listing": movies.stage_listing(listing, day, args.lenient),
        "details": movies.stage_details(details, day, args.lenient),
    }
    for name, rows in staged.items():
        target = f"{args.root}/stage/{name}"
        if args.mode == "replace":
            replace_date(rows, target, day)
        else:
            upsert_by_key(rows, target, ["stage_row_key"], key_implies_date=True, days=[day])
    finish_date(spark, state, day)  # after both tables


def movie_mart(spark: SparkSession, args: argparse.Namespace) -> None:
    listing, details = movie_tables(spark, args.root, "stage")
    if args.source == "details":
        replace_date(movies.mart_from_details(details, args.date), f"{args.root}/mart/details", args.date)
    else:
        rows = movies.mart_from_listing(listing, details, args.date)
        target = f"{args.root}/mart/listing"
        upsert_by_key(rows, target, ["mart_row_key"], key_implies_date=True, days=[args.date])


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    sub = job("stream", stream, "servers", "topic", "lake", "checkpoint")
    sub.add_argument("--every", default="60 seconds")
    sub.add_argument("--max-offsets", type=int)
    sub.add_argument("--rejects", help="folder for what cannot be decoded; by default beside the lake")

    sub = job("compact", compact, "lake")
    sub.add_argument("--first", type=dt.date.fromisoformat, required=True)
    sub.add_argument("--last", type=dt.date.fromisoformat, required=True)

    sub = job("expire", expire, "lake")
    sub.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    sub.add_argument("--months", type=int, default=1)

    sub = job("load-day", load_one_day, "lake", "table")
    sub.add_argument("date", type=dt.date.fromisoformat)
    sub.add_argument("--url", help="JDBC address; without it the table is a Parquet folder")
    sub.add_argument("--append", action="store_true", help="add the day to a Parquet table; a day it holds raises")
    sub.add_argument("--driver")
    sub.add_argument("--user", default="default")
    sub.add_argument("--password-file", help="else JDBC_PASSWORD is read")

    sub = job("mart", follow_mart, "lake", "mart", "checkpoint")
    sub.add_argument("--every", default="1 hour")
    sub.add_argument("--once", action="store_true", help="take what is there and stop")
    sub.add_argument("--deltas", action="store_true", help="add up what each batch adds, instead of rebuilding dates")

    sub = job("merge-month", merge_month, "mart")
    sub.add_argument("--month", type=dt.date.fromisoformat, required=True, help="any day of it")

    job("full-mart", rebuild_mart, "lake", "name")

    sub = job("ingest", ingest, "root", "pages", "details")
    sub.add_argument("--date", type=dt.date.fromisoformat, required=True)
    sub.add_argument("--max-pages", type=int, help="pages beyond it are left out")
    sub.add_argument("--lenient", action="store_true", help="pages that cannot be read are skipped and counted")
    sub.add_argument("--variant", action="store_true", help="documents are parsed once, as they land")

    sub = job("check", check, "root")
    sub.add_argument("--date", type=dt.date.fromisoformat, help="else all dates")

    sub = job("stage", stage, "root")
    sub.add_argument("--date", type=dt.date.fromisoformat, help="else the first one not finished")
    sub.add_argument("--first", type=dt.date.fromisoformat, default=dt.date(2026, 3, 15))
    sub.add_argument("--mode", choices=("replace", "upsert"), default="replace")
    sub.add_argument("--lenient", action="store_true", help="text that does not fit its type becomes NULL")
    sub.add_argument("--variant", action="store_true", help="the raw tables were ingested so")

    sub = job("movies", movie_mart, "root")
    sub.add_argument("--date", type=dt.date.fromisoformat, required=True)
    sub.add_argument("--source", choices=("details", "listing"), default="details")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(settings=WIDE), args)


if __name__ == "__main__":
    main()
