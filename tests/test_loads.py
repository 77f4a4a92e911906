import datetime as dt
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from salesmart.operators import loads
from salesmart.operators.audit import finish_date, load_audit, next_load_date, rows_to_load
from salesmart.operators.keys import absent_rows, enriched, inserted_if_absent, last_per_key, upserted
from salesmart.operators.retention import keep_recent
from salesmart.sources.lake import read_dataset, write_dataset

D = [dt.date(2026, 3, 15) + dt.timedelta(days=i) for i in range(5)]
SCHEMA = "k BIGINT, v STRING, load_date DATE"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def table(spark, folder, *data):
    path = f"{folder}/table"
    write_dataset(frame(spark, *data), path, ["load_date"])
    return path


def read(spark, path):
    return rows(read_dataset(spark, path, SCHEMA))


def test_replace_twice_is_replace_once(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]), (3, "c", D[1]))
    batch = frame(spark, (9, "new", D[1]), (8, "other date", D[2]))
    for _ in range(2):
        assert loads.replace_date(batch, path, D[1]) == 1
        assert read(spark, path) == [(1, "a", D[0]), (9, "new", D[1])]


def test_empty_batch_empties_the_date(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]))
    assert loads.replace_date(frame(spark), path, D[1]) == 0
    assert read(spark, path) == [(1, "a", D[0])]


def test_replace_clears_further_partitions_of_the_date(spark, folder):
    path = f"{folder}/table"
    schema = "k BIGINT, load_date DATE, region STRING"
    old = spark.createDataFrame([(1, D[0], "EU"), (2, D[1], "EU"), (3, D[1], None), (4, D[1], "007")], schema)
    write_dataset(old, path, ["load_date", "region"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        new = spark.createDataFrame([(9, D[1], "EU")], schema)
        loads.replace_date(new, path, D[1], partition_by=["region"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_dataset(spark, path, schema)) == [(1, D[0], "EU"), (9, D[1], "EU")]


def test_upsert_twice_is_upsert_once(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]), (3, "c", D[1]), (2, "other", D[2]))
    before = {p for p in Path(path).rglob("*.parquet") if f"={D[2]}" in str(p)}
    batch = frame(spark, (2, "new", D[1]), (7, "more", D[3]))
    for _ in range(2):
        assert loads.upsert_by_key(batch, path, ["load_date", "k"]) == [D[1], D[3]]
        assert read(spark, path) == [
            (1, "a", D[0]), (2, "new", D[1]), (2, "other", D[2]), (3, "c", D[1]), (7, "more", D[3]),
        ]
    assert before == {p for p in Path(path).rglob("*.parquet") if f"={D[2]}" in str(p)}


def test_upsert_finds_the_key_under_another_date(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]), (3, "c", None))
    batch = frame(spark, (2, "moved", D[3]), (3, "moved", D[3]), (None, "no key", D[0]))
    assert loads.upsert_by_key(batch, path, ["k"]) == [D[0], D[3], D[1], None]
    assert read(spark, path) == [(1, "a", D[0]), (2, "moved", D[3]), (3, "moved", D[3]), (None, "no key", D[0])]


def test_upsert_into_a_new_table(spark, folder):
    loads.upsert_by_key(frame(spark, (1, "a", D[0])), f"{folder}/new", ["load_date", "k"])
    assert read(spark, f"{folder}/new") == [(1, "a", D[0])]


def test_swap_is_completed_from_the_copy(spark, folder, monkeypatch):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]), (3, "c", D[1]))
    schema = spark.createDataFrame([], SCHEMA).schema

    def fail(spark, beside, path, *rest):
        loads.clear_dates(spark, path, [D[1]])  # the old date is gone, the new one not there yet
        raise RuntimeError(beside)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError) as failure:
        patch.setattr(loads, "swap_dates", fail)
        loads.upsert_by_key(frame(spark, (2, "new", D[1])), path, ["load_date", "k"])
    assert read(spark, path) == [(1, "a", D[0])]
    loads.swap_dates(spark, str(failure.value), path, schema, [D[1]])
    assert read(spark, path) == [(1, "a", D[0]), (2, "new", D[1]), (3, "c", D[1])]


def test_first_write_wins(spark, folder):
    path = table(spark, folder, (1, "first", D[0]))
    batch = frame(spark, (1, "second", D[0]), (1, "other date", D[1]), (2, "new", D[0]))
    assert loads.insert_if_absent(batch, path, ["load_date", "k"]) == 2
    assert loads.insert_if_absent(batch, path, ["load_date", "k"]) == 0
    assert read(spark, path) == [(1, "first", D[0]), (1, "other date", D[1]), (2, "new", D[0])]


def test_insert_checks_the_batch(spark, folder):
    path = f"{folder}/table"
    with pytest.raises(ValueError, match="1 repeated"):
        loads.insert_if_absent(frame(spark, (1, "a", D[0]), (1, "b", D[0])), path, ["load_date", "k"])
    with pytest.raises(ValueError, match="2 incomplete"):
        loads.insert_if_absent(frame(spark, (None, "a", D[0]), (None, "b", D[0])), path, ["load_date", "k"])
    with pytest.raises(ValueError, match="must hold"):
        loads.insert_if_absent(frame(spark, (1, "a", D[0])), path, ["k"])
    assert not Path(path).exists()


def test_two_tables_or_none(spark, folder):
    good, bad = frame(spark, (1, "a", D[0])), frame(spark, (1, "a", D[0]), (1, "b", D[0]))
    one, two = f"{folder}/one", f"{folder}/two"
    with pytest.raises(ValueError):
        loads.load_together({one: good, two: bad}, ["load_date", "k"])
    assert not Path(one).exists()
    loads.insert_if_absent(good, one, ["load_date", "k"])  # as if the second write had failed
    assert loads.load_together({one: good, two: good}, ["load_date", "k"]) == {one: 0, two: 1}
    assert read(spark, one) == read(spark, two) == [(1, "a", D[0])]


def test_frame_level_operators(spark):
    old = frame(spark, (1, "a", D[0]), (2, "b", D[0]), (None, "n", D[0]))
    new = frame(spark, (2, "B", D[0]), (3, "C", D[0]), (None, "N", D[0]))
    assert rows(absent_rows(new, old, ["k"])) == [(3, "C", D[0]), (None, "N", D[0])]
    assert [r[1] for r in rows(inserted_if_absent(old, new, ["k"]))] == ["a", "b", "C", "N", "n"]
    assert [r[1] for r in rows(upserted(old, new, ["k"]))] == ["a", "B", "C", "N"]
    listed = spark.createDataFrame([(1,), (1,), (4,)], "k BIGINT")
    assert rows(enriched(listed, old, ["k"])) == [(1, "a", D[0])] * 2


def test_last_per_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, None, "n"), (2, 0, "m")], "k INT, s INT, v STRING")
    assert rows(last_per_key(df, ["k"], ["s"])) == [(1, 3, "z"), (2, 0, "m")]


def test_load_day(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", D[1]))
    schema = spark.createDataFrame([], SCHEMA).schema
    target = f"{folder}/target"

    def sink(df):
        write_dataset(df, target, ["load_date"])

    assert loads.load_day(spark, path, schema, D[4], sink, "load_date") == 0
    assert not Path(target).exists()
    assert loads.load_day(spark, path, schema, D[1], sink, "load_date") == 1
    assert loads.load_day(spark, path, schema, D[1], sink, "load_date") == 1  # plain append repeats
    assert read(spark, target) == [(2, "b", D[1])] * 2


def test_cursor(spark, folder):
    source = frame(spark, *[(i, "s", day) for i, day in enumerate(D)])
    state = f"{folder}/state"
    assert next_load_date(spark, state, D[0]) == D[0]
    for day in (D[0], D[2], D[0]):
        finish_date(spark, state, day)
    assert next_load_date(spark, state, D[0]) == D[1]  # a date finished ahead is no reason to skip one
    assert rows(rows_to_load(source, state, D[0])) == [(1, "s", D[1])]
    finish_date(spark, state, D[1])
    assert rows(rows_to_load(source, state, D[0])) == [(3, "s", D[3])]
    assert rows(rows_to_load(source, state, D[0], load_date=D[4])) == [(4, "s", D[4])]


def test_upsert_with_null_dates_and_wrong_days(spark, folder):
    path = table(spark, folder, (1, "a", D[0]), (2, "b", None), (3, "c", D[1]))
    batch = frame(spark, (2, "new", None), (4, "more", D[0]))
    for _ in range(2):
        assert loads.upsert_by_key(batch, path, ["load_date", "k"]) == [D[0], None]
        assert read(spark, path) == [(1, "a", D[0]), (2, "new", None), (3, "c", D[1]), (4, "more", D[0])]
    with pytest.raises(ValueError, match="not among its days"):
        loads.upsert_by_key(frame(spark, (3, "x", D[1])), path, ["load_date", "k"], days=[D[0]])
    assert (3, "c", D[1]) in read(spark, path)


def test_batches_are_computed_once(spark, folder):
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    batch = frame(spark, (1, "a", D[0]), (2, "b", D[1])).mapInPandas(seen, SCHEMA)
    loads.load_together({f"{folder}/one": batch, f"{folder}/two": batch}, ["load_date", "k"])
    assert counted.value == 4
    loads.upsert_by_key(batch, f"{folder}/one", ["load_date", "k"])
    assert counted.value == 6


def test_append_day(spark, folder):
    rows_ = frame(spark, (1, "a", D[0]))
    assert loads.append_day(rows_, f"{folder}/t", D[0], "load_date") == 1
    with pytest.raises(ValueError, match="holds"):
        loads.append_day(rows_, f"{folder}/t", D[0], "load_date")
    assert loads.append_day(frame(spark, (2, "b", D[1])), f"{folder}/t", D[1], "load_date") == 1


def test_a_sink_log_is_refused(spark, folder):
    path = table(spark, folder, (1, "a", D[0]))
    Path(f"{path}/_spark_metadata").mkdir()
    for change in (
        lambda: write_dataset(frame(spark, (2, "b", D[0])), path, ["load_date"]),
        lambda: loads.replace_date(frame(spark), path, D[0]),
        lambda: loads.clear_dates(spark, path, [D[0]]),
        lambda: loads.rewrite_dates(frame(spark, (2, "b", D[0])), path, [D[0]]),
    ):
        with pytest.raises(ValueError, match="sink"):
            change()


def test_audit(spark):
    listing = frame(spark, (1, "", D[0]), (1, "", D[0]), (2, "", D[0]), (2, "", D[1]), (None, "", D[1]))
    details = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k BIGINT")
    assert rows(load_audit(listing, details, ["k"], "load_date")) == [(D[0], 3, 2, 1), (D[1], 2, 0, 2)]


def add_month(moment: dt.datetime) -> dt.datetime:
    year, month = moment.year + moment.month // 12, moment.month % 12 + 1
    last = (dt.datetime(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return moment.replace(year=year, month=month, day=min(moment.day, last))


MOMENTS = [dt.datetime(2024, 1, 20) + dt.timedelta(hours=6 * i) for i in range(200)]


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 2, 29), dt.datetime(2024, 2, 29, 12), dt.datetime(2024, 3, 15, 7)])
def test_retention_with_short_months(spark, folder, as_of):
    expected = sorted(m for m in MOMENTS if add_month(m) > as_of)
    df = spark.createDataFrame([(m, m.date()) for m in MOMENTS], "ts TIMESTAMP, event_date DATE")
    assert sorted(r["ts"] for r in keep_recent(df, "ts", as_of).collect()) == expected
    path = f"{folder}/events"
    write_dataset(df, path, ["event_date"])
    for _ in range(2):
        loads.expire_rows(spark, path, df.schema, "ts", as_of)
        assert sorted(r["ts"] for r in read_dataset(spark, path, df.schema).collect()) == expected


def test_retention_keeps_rows_without_a_moment_and_takes_a_condition(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2020, 1, 1)), (3, dt.datetime(2020, 1, 2))], "k INT, ts TIMESTAMP")
    as_of = dt.datetime(2024, 1, 1)
    assert [r["k"] for r in keep_recent(df, "ts", as_of).collect()] == [1]
    kept = keep_recent(df, "ts", as_of, only_where=F.col("k") == 2)
    assert sorted(r["k"] for r in kept.collect()) == [1, 3]


def test_retention_filter_reaches_the_scan(spark, folder):
    spark.createDataFrame([(m,) for m in MOMENTS], "ts TIMESTAMP").write.parquet(f"{folder}/e")
    kept = keep_recent(spark.read.parquet(f"{folder}/e"), "ts", dt.datetime(2024, 3, 1))
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(ts),GreaterThan(ts,2024-01-30" in text
