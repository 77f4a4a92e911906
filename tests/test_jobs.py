import datetime as dt
import json

import pytest
from helpers import rows
from test_streaming import arrive, events, lake, to_lake

from pyspark.sql import functions as F

from salesmart import jobs
from salesmart.operators.loads import replace_date
from salesmart.plans import sales as model
from salesmart.sources.lake import read_dataset, write_dataset
from salesmart.streaming.deltas import read_delta_mart


def test_sales_jobs(spark, folder):
    arrive(spark, folder, events(0, 12) + events(12, 6, day=1))
    to_lake(spark, folder)
    place = ["--lake", f"{folder}/lake"]
    for _ in range(2):
        jobs.main(["load-day", "2024-05-11", *place, "--table", f"{folder}/warehouse"], spark)
    loaded = read_dataset(spark, f"{folder}/warehouse", model.LAKE_SCHEMA)
    assert rows(loaded) == rows(lake(spark, folder).filter("event_date = DATE'2024-05-11'")) and loaded.count() == 6

    jobs.main(["mart", *place, "--mart", f"{folder}/mart", "--checkpoint", f"{folder}/c9", "--once"], spark)
    followed = spark.read.parquet(f"{folder}/mart")
    jobs.main(["full-mart", *place, "--name", "rebuilt_mart"], spark)
    assert rows(spark.table("rebuilt_mart").select(followed.columns)) == rows(followed)

    deltas = ["--mart", f"{folder}/deltas", "--checkpoint", f"{folder}/c8"]
    jobs.main(["mart", *place, *deltas, "--once", "--deltas"], spark)
    jobs.main(["merge-month", *deltas[:2], "--month", "2024-05-11"], spark)
    assert rows(read_delta_mart(spark, f"{folder}/deltas").select(followed.columns)) == rows(followed)


@pytest.fixture
def root(spark, folder):
    day, at = dt.date(2026, 3, 15), dt.datetime(2026, 3, 15, 8)
    payload = {"title": "t", "runtime": 90, "popularity": 1.5}
    data = [(i, i % 3, json.dumps(payload | {"runtime": i}), at, day + dt.timedelta(days=i // 3)) for i in range(6)]
    raw = spark.createDataFrame(data, jobs.RAW_MOVIES)
    write_dataset(raw, f"{folder}/raw/listing", ["load_date"])
    write_dataset(raw.filter("movie_id < 2"), f"{folder}/raw/details", ["load_date"])
    return folder


@pytest.mark.parametrize("mode", ["replace", "upsert"])
def test_movie_jobs(spark, root, mode):
    for _ in range(2):
        jobs.main(["stage", "--root", root, "--date", "2026-03-15", "--mode", mode], spark)
    jobs.main(["stage", "--root", root, "--mode", mode], spark)  # the next date
    listing, details = jobs.movie_tables(spark, root, "stage")
    assert (listing.count(), details.count()) == (6, 4)
    for source in ("details", "listing"):
        for _ in range(2):
            jobs.main(["movies", "--root", root, "--date", "2026-03-16", "--source", source], spark)
    found = spark.read.parquet(f"{root}/mart/details")
    assert rows(found.select("movie_id", "runtime_minutes")) == [(0, 3), (1, 4)]
    found = spark.read.parquet(f"{root}/mart/listing")
    assert rows(found.select("movie_id", "runtime_minutes")) == [(0, 3), (1, 4), (2, None)]


def test_from_pages_to_the_mart(spark, folder):
    day = dt.date(2026, 3, 15)

    def page(*items):
        return json.dumps({"results": [{"id": i, "title": t} for i, t in items]})

    pages = [(day, 1, page((1, "a"), (2, "b"))), (day, 2, page((1, "again"))), (day, 3, page((9, "last page")))]
    at = [dt.datetime(2026, 3, 15, hour) for hour in (9, 8, 9, 9)]
    fetched = [(1, 91), (1, 999), (2, 92), (77, 5)]  # the second is older, the last is not listed
    detail = [(day, when, json.dumps({"id": i, "runtime": n})) for when, (i, n) in zip(at, fetched, strict=True)]
    spark.createDataFrame(pages, "load_date DATE, page INT, body STRING").write.parquet(f"{folder}/pages")
    spark.createDataFrame(detail, "load_date DATE, fetched_at TIMESTAMP, body STRING").write.parquet(
        f"{folder}/found"
    )
    place = ["--root", folder]
    taken = ["--pages", f"{folder}/pages", "--details", f"{folder}/found", "--date", "2026-03-15"]
    for _ in range(2):
        jobs.main(["ingest", *place, *taken], spark)
    jobs.main(["stage", *place], spark)
    jobs.main(["check", *place], spark)
    jobs.main(["movies", *place, "--date", "2026-03-15", "--source", "listing"], spark)
    found = spark.read.parquet(f"{folder}/mart/listing")
    assert rows(found.select("movie_id", "title", "runtime_minutes")) == [
        (1, "again", 91), (2, "b", 92), (9, "last page", None),
    ]
    assert spark.read.parquet(f"{folder}/raw/details").count() == 2
    replace_date(spark.read.parquet(f"{folder}/stage/listing").withColumn("raw_id", F.lit(1)), f"{folder}/bad", day)
    bad = spark.read.parquet(f"{folder}/bad")
    write_dataset(bad, f"{folder}/stage/listing", ["load_date"])
    with pytest.raises(ValueError, match=r"unique\(raw_id\): [123]"):
        jobs.main(["check", *place], spark)


def test_pages_that_cannot_be_read(spark, folder):
    day = dt.date(2026, 3, 15)
    good = json.dumps({"results": [{"id": 1}]})
    pages = [(day, 1, good), (day, 2, good[:-4]), (day, 3, "<html>busy</html>"), (day, 4, None)]
    spark.createDataFrame(pages, "load_date DATE, page INT, body STRING").write.parquet(f"{folder}/pages")
    spark.createDataFrame([], "load_date DATE, fetched_at TIMESTAMP, body STRING").write.parquet(f"{folder}/found")
    job = ["ingest", "--root", folder, "--pages", f"{folder}/pages", "--details", f"{folder}/found", "--date", "2026-03-15"]
    with pytest.raises(Exception, match="MALFORMED_RECORD|without a body"):
        jobs.main(job, spark)
    jobs.main([*job, "--lenient"], spark)
    assert spark.read.parquet(f"{folder}/raw/listing").count() == 1
    jobs.main([*job, "--lenient", "--max-pages", "1"], spark)


def test_the_cursor_waits_for_both_tables_and_passes_empty_days(spark, root, monkeypatch):
    """Raw rows lie on 15 and 16 March only."""
    def day():
        return jobs.next_load_date(spark, f"{root}/state/staged", dt.date(2026, 3, 15))

    real = jobs.replace_date

    def fails_on_details(rows, target, when):
        if target.endswith("details"):
            raise RuntimeError("lost")
        return real(rows, target, when)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(jobs, "replace_date", fails_on_details)
        jobs.main(["stage", "--root", root], spark)
    assert day() == dt.date(2026, 3, 15)
    jobs.main(["stage", "--root", root, "--date", "2026-03-17"], spark)  # an empty day, ahead of its turn
    for expected in (16, 18):
        jobs.main(["stage", "--root", root], spark)
        assert day() == dt.date(2026, 3, expected)
    listing, details = jobs.movie_tables(spark, root, "stage")
    assert (listing.count(), details.count()) == (6, 4)


def test_lake_jobs(spark, folder):
    arrive(spark, folder, events(0, 12) + events(12, 6, day=1) + events(20, 4, day=32))
    to_lake(spark, folder)
    jobs.main(["compact", "--lake", f"{folder}/lake", "--first", "2024-05-10", "--last", "2024-05-12"], spark)
    assert lake(spark, folder).count() == 22
    jobs.main(["expire", "--lake", f"{folder}/lake", "--as-of", "2024-06-12"], spark)
    assert lake(spark, folder).count() == 4


def test_database_job(spark, folder, monkeypatch):
    arrive(spark, folder, events(0, 3))
    to_lake(spark, folder)
    calls = []
    monkeypatch.setattr(jobs, "append_jdbc", lambda df, *rest: calls.append((df.count(), *rest)))
    monkeypatch.setenv("JDBC_PASSWORD", "p")
    jobs.main(
        ["load-day", "2024-05-10", "--lake", f"{folder}/lake", "--table", "t", "--url", "jdbc:x", "--driver", "d"], spark
    )
    assert calls == [(3, "jdbc:x", "t", "d", {"user": "default", "password": "p"})]


def test_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["stream", "--topic", "t"])
    with pytest.raises(SystemExit):
        jobs.main(["load-day", "yesterday", "--lake", "l", "--table", "t"])
