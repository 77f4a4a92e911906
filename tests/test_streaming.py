import datetime as dt
from pathlib import Path

import pytest
from helpers import rows
from test_sales import envelope, wrapped

from pyspark.sql import functions as F

from salesmart.operators import loads
from salesmart.plans import sales as model
from salesmart.sources.kafka import recorded_changes
from salesmart.sources.lake import read_dataset, read_day, write_batch
from salesmart.streaming.lake import start_lake_stream
from salesmart.streaming.mart import sales_mart, start_mart_stream

DAY = 24 * 3600 * 1_000_000
START = 1715299200000000  # 2024-05-10


def arrive(spark, folder, events):
    when = dt.datetime(2024, 5, 10, 15)
    data = [(bytearray(wrapped(e).encode()), when) for e in events]
    df = spark.createDataFrame(data, "value BINARY, timestamp TIMESTAMP")
    df.repartition(2).write.mode("append").parquet(f"{folder}/records")


def events(first, n, day=0, **changes):
    return [
        envelope(id=i, order_id=f"o{i // 2}", region=["EU", "US", None][i % 3], created_at=START + day * DAY + i, **changes)
        for i in range(first, first + n)
    ]


def to_lake(spark, folder, **options):
    decoded = model.decode_changes(recorded_changes(spark, f"{folder}/records", 1))
    query = start_lake_stream(decoded, f"{folder}/lake", f"{folder}/c1", every=None, **options)
    query.awaitTermination()
    return query


def to_mart(spark, folder, **options):
    options = {"every": None, **options}
    query = start_mart_stream(spark, f"{folder}/lake", f"{folder}/mart", f"{folder}/c2", **options)
    query.awaitTermination()


def lake(spark, folder):
    return read_dataset(spark, f"{folder}/lake", model.LAKE_SCHEMA)


@pytest.mark.parametrize("spread", [True, False])
def test_stream_equals_batch_and_restart_adds_nothing(spark, folder, spread):
    arrive(spark, folder, events(0, 20) + events(20, 10, day=1, op="r") + events(30, 5, op="u"))
    to_lake(spark, folder, spread=spread)
    batch = model.decode_changes(spark.read.parquet(f"{folder}/records"))
    columns = lake(spark, folder).columns
    assert rows(lake(spark, folder)) == rows(batch.select(columns)) and batch.count() == 30
    to_lake(spark, folder, spread=spread)
    assert lake(spark, folder).count() == 30


def test_a_spread_write_adds_few_files(spark, folder):
    for _ in range(3):
        arrive(spark, folder, events(0, 20) + events(20, 20, day=1))
    decoded = model.decode_changes(recorded_changes(spark, f"{folder}/records"))
    start_lake_stream(decoded, f"{folder}/lake", f"{folder}/c1", every=None).awaitTermination()
    files = [len(list(d.rglob("*.parquet"))) for d in Path(f"{folder}/lake").glob("event_date=*")]
    assert files == [1, 1]  # from six input files


def test_mart_follows_the_lake(spark, folder):
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_mart(spark, folder)
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/mart").select("total_orders").collect())) == [(4,)] * 3
    # Late rows for the old day that belong to orders it holds already, and a new day.
    arrive(spark, folder, events(6, 9) + events(40, 4, day=1) + [envelope(id=90, created_at=None)])
    to_lake(spark, folder)
    to_mart(spark, folder, max_files_per_trigger=1)
    expected = sales_mart(lake(spark, folder))
    found = spark.read.parquet(f"{folder}/mart")
    assert rows(found.select(expected.columns)) == rows(expected)
    old_day = found.filter("event_date = DATE'2024-05-10'").agg({"total_orders": "sum"}).first()[0]
    assert old_day == 21 and found.filter("event_date IS NULL").count() == 1


def test_refresh_after_a_lost_checkpoint_gives_the_same_mart(spark, folder):
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_mart(spark, folder)
    once = rows(spark.read.parquet(f"{folder}/mart"))
    start_mart_stream(
        spark, f"{folder}/lake", f"{folder}/mart", f"{folder}/c3", every=None
    ).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/mart")) == once


def test_timed_trigger(spark, folder):
    arrive(spark, folder, events(0, 3))
    decoded = model.decode_changes(recorded_changes(spark, f"{folder}/records"))
    query = start_lake_stream(decoded, f"{folder}/lake", f"{folder}/c1", every="1 second", name="timed")
    try:
        query.processAllAvailable()
        assert lake(spark, folder).count() == 3 and query.name == "timed"
    finally:
        query.stop()


def test_rejects_are_reported_per_micro_batch(spark, folder):
    arrive(spark, folder, events(0, 4) + events(4, 3, op="d"))
    decoded = model.decode_changes(recorded_changes(spark, f"{folder}/records"), observe="changes")
    query = start_lake_stream(decoded, f"{folder}/lake", f"{folder}/c1", every=None)
    query.awaitTermination()
    totals = [p["observedMetrics"]["changes"] for p in query.recentProgress if "changes" in p["observedMetrics"]]
    assert sum(t["read"] for t in totals) == 7 and sum(t["kept"] for t in totals) == 4


def test_bad_records_go_to_rejects_and_the_stream_goes_on(spark, folder):
    when = dt.datetime(2024, 5, 10, 15)
    good = wrapped(envelope(id=1, created_at=START))
    odd = [
        wrapped(envelope(id=2, created_at=START, unit_price="*no base64*")),
        "{broken",
        "7",
        wrapped(envelope(id=3, op="u", created_at=START)),
    ]
    data = [(bytearray(v.encode()), when) for v in (good, *odd)]
    spark.createDataFrame(data, "value BINARY, timestamp TIMESTAMP").write.parquet(f"{folder}/records")

    def run():
        decoded = model.decode_or_reject(recorded_changes(spark, f"{folder}/records", 1), observe="changes")
        start_lake_stream(
            decoded, f"{folder}/lake", f"{folder}/c1", every=None, rejects=f"{folder}/rejects"
        ).awaitTermination()

    run()
    assert [r["id"] for r in lake(spark, folder).collect()] == [1]
    found = rows(spark.read.parquet(f"{folder}/rejects").selectExpr("cast(value AS STRING)", "reject_reason"))
    assert found == sorted([(odd[0], "bad amount"), (odd[1], "not a change event"), (odd[2], "not a change event")])
    arrive(spark, folder, events(10, 2))
    run()
    assert lake(spark, folder).count() == 3


def test_every_writer_shares_the_lake(spark, folder):
    """A backfill beside a stream is seen, replaces itself, expires and is compacted."""
    arrive(spark, folder, events(0, 12) + events(12, 6, day=1))
    to_lake(spark, folder)
    path = f"{folder}/lake"
    extra = spark.createDataFrame(
        lake(spark, folder).filter("id < 3").withColumn("id", F.col("id") + 100).collect(), lake(spark, folder).schema
    )
    for _ in range(2):
        write_batch(extra, path, "backfill")
        assert lake(spark, folder).count() == 21
    schema = lake(spark, folder).schema
    before = rows(lake(spark, folder))
    loads.compact_days(spark, path, schema, [dt.date(2024, 5, 10)])
    assert rows(lake(spark, folder)) == before
    assert [p.name for p in Path(path, "event_date=2024-05-10").iterdir() if p.is_dir()] == ["batch=compact-2024-05-10"]
    to_lake(spark, folder)  # a restart adds nothing
    assert rows(lake(spark, folder)) == before
    with_batch = read_dataset(spark, path, f"{model.LAKE_SCHEMA}, batch STRING").schema
    # In the middle of the first day: the rows lie in its first microseconds.
    loads.expire_rows(spark, path, with_batch, "event_time", dt.datetime(2024, 6, 10, 12), further=["batch"])
    assert lake(spark, folder).count() == 6
    assert read_day(spark, path, dt.date(2024, 5, 11), schema).count() == 6
    assert read_day(spark, path, dt.date(2030, 1, 1), schema).count() == 0


def test_a_repeated_micro_batch_replaces_itself(spark, folder):
    arrive(spark, folder, events(0, 9))
    to_lake(spark, folder)
    commits = sorted(Path(f"{folder}/c1/commits").glob("[0-9]*"))
    for old in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        old.unlink(missing_ok=True)  # as if the driver had died before the commit
    to_lake(spark, folder)
    assert lake(spark, folder).count() == 9


def test_untouched_dates_keep_their_files(spark, folder):
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_mart(spark, folder)
    old = {p for p in Path(f"{folder}/mart/event_date=2024-05-10").glob("*.parquet")}
    arrive(spark, folder, events(40, 4, day=1))
    to_lake(spark, folder)
    to_mart(spark, folder)
    assert old and old == {p for p in Path(f"{folder}/mart/event_date=2024-05-10").glob("*.parquet")}
    assert spark.read.parquet(f"{folder}/mart").select("event_date").distinct().count() == 2
