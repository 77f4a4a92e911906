"""Micro-batches that fail and are run again, and the mart that adds up deltas."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from helpers import rows
from test_sales import envelope
from test_streaming import START, arrive, events, lake, to_lake

from salesmart.operators.key_index import seen_keys
from salesmart.plans import sales as model
from salesmart.sources.kafka import recorded_changes
from salesmart.sources.lake import clear_batch, read_dataset, write_batch
from salesmart.streaming import deltas
from salesmart.streaming import lake as lake_stream
from salesmart.streaming.attempts import Attempt, Attempts
from salesmart.streaming.mart import sales_mart


def to_delta_mart(spark, folder, **options):
    query = deltas.start_delta_mart_stream(spark, f"{folder}/lake", f"{folder}/mart", f"{folder}/c2", every=None, **options)
    query.awaitTermination()


def assert_mart_follows(spark, folder):
    expected = sales_mart(lake(spark, folder))
    found = deltas.read_delta_mart(spark, f"{folder}/mart")
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def forget_commit(checkpoint):
    """As if the driver had died before it noted the last micro-batch as done."""
    last = max(Path(checkpoint, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)


def failing_once(monkeypatch, module, name, fails, before=True):
    """The function raises on its first call for which ``fails`` is true, before or after its work."""
    real, left = getattr(module, name), [1]

    def wrapped(*args, **options):
        now = left[0] and fails(*args)
        if now and before:
            left[0] = 0
            raise RuntimeError("lost")
        result = real(*args, **options)
        if now:
            left[0] = 0
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(module, name, wrapped)


# The ledger


def test_ledger(spark, folder):
    attempts = Attempts(spark, f"{folder}/ledger")
    assert attempts.begin(0) is Attempt.AGAIN and attempts.unfinished() == [0]
    assert attempts.begin(0) is Attempt.AGAIN
    attempts.finish(0)
    assert attempts.unfinished() == [] and attempts.begin(0) is Attempt.WRITTEN
    assert attempts.begin(1) is Attempt.FIRST
    restarted = Attempts(spark, f"{folder}/ledger")
    assert restarted.begin(1) is Attempt.AGAIN
    restarted.finish(1)
    assert restarted.begin(2) is Attempt.FIRST and restarted.unfinished() == [2]
    assert len([p for p in Path(f"{folder}/ledger").iterdir() if not p.name.startswith(".")]) == 2


def test_without_its_ledger_a_stream_looks_for_leftovers(spark, folder):
    assert Attempts(spark, f"{folder}/new").begin(7) is Attempt.AGAIN


def test_clear_batch_finds_all_dates(spark, folder):
    some = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 2)), (3, None)], "id INT, event_date DATE")
    write_batch(some, folder, "a")
    write_batch(some, folder, "b", fresh=True)
    assert clear_batch(spark, folder, "b") == 3
    assert sorted(r["id"] for r in read_dataset(spark, folder, "id INT, event_date DATE").collect()) == [1, 2, 3]
    assert clear_batch(spark, f"{folder}/nowhere", "b") == 0


# The lake


def test_a_batch_that_failed_after_its_write_is_not_there_twice(spark, folder, monkeypatch):
    arrive(spark, folder, events(0, 9))
    to_lake(spark, folder)
    arrive(spark, folder, events(9, 9, day=1))
    failing_once(monkeypatch, lake_stream, "write_batch", lambda *a: True, before=False)
    with pytest.raises(Exception, match="lost"):
        to_lake(spark, folder)
    assert lake(spark, folder).count() > 9  # written, not noted as finished
    to_lake(spark, folder)
    assert sorted(r["id"] for r in lake(spark, folder).select("id").collect()) == list(range(18))


def test_leftovers_on_other_dates_go(spark, folder, monkeypatch):
    """An attempt that wrote a date the next one does not have leaves nothing there."""
    arrive(spark, folder, events(0, 4))
    to_lake(spark, folder)
    arrive(spark, folder, events(4, 4, day=1))
    real = lake_stream.write_batch

    def odd(batch, path, label, *args, **options):
        wrong = batch.withColumn("event_date", model.F.lit(dt.date(2031, 1, 1)))
        real(wrong, path, label, *args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake_stream, "write_batch", odd)
    with pytest.raises(Exception, match="lost"):
        to_lake(spark, folder)
    monkeypatch.setattr(lake_stream, "write_batch", real)
    to_lake(spark, folder)
    assert lake(spark, folder).count() == 8
    assert lake(spark, folder).filter("event_date > DATE'2030-01-01'").count() == 0


def test_a_written_batch_is_not_written_again(spark, folder, monkeypatch):
    arrive(spark, folder, events(0, 9))
    to_lake(spark, folder)
    files = sorted(Path(f"{folder}/lake").rglob("*.parquet"))
    forget_commit(f"{folder}/c1")
    to_lake(spark, folder)
    assert files == sorted(Path(f"{folder}/lake").rglob("*.parquet"))
    # Also where compaction has moved the rows to another batch in the meantime.
    forget_commit(f"{folder}/c1")
    from salesmart.operators import loads

    loads.compact_days(spark, f"{folder}/lake", lake(spark, folder).schema, [dt.date(2024, 5, 10)])
    to_lake(spark, folder)
    assert lake(spark, folder).count() == 9


def test_rejects_of_a_failed_batch_are_not_there_twice(spark, folder, monkeypatch):
    arrive(spark, folder, events(0, 2))

    def run():
        decoded = model.decode_or_reject(recorded_changes(spark, f"{folder}/records", 1))
        lake_stream.start_lake_stream(
            decoded, f"{folder}/lake", f"{folder}/c1", every=None, rejects=f"{folder}/rejects"
        ).awaitTermination()

    run()
    bad = [(bytearray(b"{broken"), dt.datetime(2024, 5, 10))]
    spark.createDataFrame(bad, "value BINARY, timestamp TIMESTAMP").write.mode("append").parquet(f"{folder}/records")
    failing_once(monkeypatch, lake_stream, "write_dataset", lambda *a: True, before=False)
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert spark.read.parquet(f"{folder}/rejects").count() == 1 and lake(spark, folder).count() == 2


# The mart


def test_mart_adds_late_rows_known_orders_and_nulls(spark, folder):
    arrive(spark, folder, events(0, 12) + [envelope(id=90, created_at=None), envelope(id=91, order_id=None, created_at=START)])
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    assert_mart_follows(spark, folder)
    # Rows of orders that are known, late ones, a new day and month, and more without a date or order.
    arrive(
        spark, folder,
        events(6, 9) + events(40, 4, day=1) + events(60, 4, day=40, rating=None, total_price=None)
        + [envelope(id=92, created_at=None, order_id="x"), envelope(id=93, order_id=None, created_at=START)],
    )
    to_lake(spark, folder)
    to_delta_mart(spark, folder, max_files_per_trigger=1)
    assert_mart_follows(spark, folder)
    to_delta_mart(spark, folder)  # nothing new
    assert_mart_follows(spark, folder)


def test_mart_does_not_read_the_lake_again(spark, folder):
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    kept = [tuple(r) for r in lake(spark, folder).collect()]
    schema = lake(spark, folder).schema
    shutil.rmtree(f"{folder}/lake/event_date=2024-05-10")
    arrive(spark, folder, events(6, 9))  # orders 3 to 5 are known from rows that are gone
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    expected = sales_mart(spark.createDataFrame(kept, schema).unionByName(lake(spark, folder)))
    assert rows(deltas.read_delta_mart(spark, f"{folder}/mart")) == rows(expected)


@pytest.mark.parametrize("write", ["add_keys", "write_dataset"])
@pytest.mark.parametrize("before", [True, False])
def test_a_failed_batch_is_not_seen_and_counts_once(spark, folder, monkeypatch, write, before):
    """Lost before or after its orders or its parts are written."""
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    seen = rows(deltas.read_delta_mart(spark, f"{folder}/mart"))
    arrive(spark, folder, events(6, 9) + events(40, 4, day=1))
    to_lake(spark, folder)
    failing_once(monkeypatch, deltas, write, lambda *a: True, before)
    with pytest.raises(Exception, match="lost"):
        to_delta_mart(spark, folder)
    assert rows(deltas.read_delta_mart(spark, f"{folder}/mart")) == seen
    to_delta_mart(spark, folder)
    assert_mart_follows(spark, folder)


def test_a_finished_batch_is_not_added_again(spark, folder):
    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    forget_commit(f"{folder}/c2")
    to_delta_mart(spark, folder)
    assert_mart_follows(spark, folder)


def test_merged_months_give_the_same_mart_and_know_their_orders(spark, folder):
    for first in (0, 6):
        arrive(spark, folder, events(first, 9) + [envelope(id=90 + first, created_at=None, order_id="x")])
        to_lake(spark, folder)
        to_delta_mart(spark, folder)
    before = deltas.mart_parts(spark, f"{folder}/mart").count()
    for period in (dt.date(2024, 5, 1), None):
        deltas.merge_period(spark, f"{folder}/mart", period)
    assert deltas.mart_parts(spark, f"{folder}/mart").count() < before
    assert_mart_follows(spark, folder)
    arrive(spark, folder, events(3, 9))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    assert_mart_follows(spark, folder)


def test_a_mart_without_batches_is_empty(spark, folder):
    assert deltas.read_delta_mart(spark, f"{folder}/mart").count() == 0


def test_only_the_files_of_touched_dates_are_read(spark, folder):
    arrive(spark, folder, events(0, 4) + events(10, 4, day=40))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    batch = spark.createDataFrame([(dt.date(2024, 5, 10), "EU", "c", "o")], deltas.ORDERS_SCHEMA)
    plan = seen_keys(batch, f"{folder}/mart/orders", deltas.ORDERS_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-05-01" in plan and "GreaterThanOrEqual(event_date,2024-05-10)" in plan


def test_merged_and_expired_days_of_the_lake_add_nothing(spark, folder):
    from salesmart.operators import loads

    arrive(spark, folder, events(0, 12))
    to_lake(spark, folder)
    to_delta_mart(spark, folder)
    before = rows(deltas.read_delta_mart(spark, f"{folder}/mart"))
    schema = lake(spark, folder).schema
    loads.compact_days(spark, f"{folder}/lake", schema, [dt.date(2024, 5, 10)])
    to_delta_mart(spark, folder)
    with_batch = read_dataset(spark, f"{folder}/lake", f"{model.LAKE_SCHEMA}, batch STRING").schema
    loads.expire_rows(spark, f"{folder}/lake", with_batch, "event_time", dt.datetime(2024, 6, 10), further=["batch"])
    to_delta_mart(spark, folder)
    assert rows(deltas.read_delta_mart(spark, f"{folder}/mart")) == before
