"""Files swapped for others, and retention and compaction by files."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import rows

from salesmart.operators import loads, swaps
from salesmart.session import use_settings
from salesmart.sources.lake import read_dataset, write_batch, write_dataset

SCHEMA = "k INT, ts TIMESTAMP, event_date DATE"
DAY = dt.date(2024, 5, 10)
# A month after noon of the day.
AS_OF = dt.datetime(2024, 6, 10, 12)


def sale(k, hour, day=DAY):
    return k, dt.datetime.combine(day, dt.time(hour)), day


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA).coalesce(1)


def written(spark, path, *files):
    for file in files:
        write_dataset(frame(spark, *file), path, ["event_date"])


def keys(spark, path):
    return sorted(r["k"] for r in read_dataset(spark, path, SCHEMA).collect())


def names(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def holder(spark, path, k):
    found = read_dataset(spark, path, SCHEMA).filter(f"k = {k}").selectExpr("_metadata.file_path").collect()
    return "/" + found[0][0].removeprefix("file:").lstrip("/")


def test_only_files_with_both_are_rewritten(spark, folder):
    path = f"{folder}/t"
    old, both, young = [sale(1, 8)], [sale(2, 9), sale(3, 15)], [sale(4, 16)]
    before, after = [sale(5, 1, dt.date(2024, 5, 9))], [sale(6, 1, dt.date(2024, 5, 11))]
    written(spark, path, old, both, young, before, after)
    kept = {holder(spark, path, 4), holder(spark, path, 6)}
    assert loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF) == [dt.date(2024, 5, 9), DAY]
    assert keys(spark, path) == [3, 4, 6]
    assert kept < names(path) and len(names(path)) == 3
    same = names(path)
    assert loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF) == []
    assert names(path) == same


def test_rows_at_the_limit_and_without_a_moment(spark, folder):
    path = f"{folder}/t"
    written(spark, path, [sale(1, 12), (2, None, DAY)], [(3, None, None)], [sale(4, 12)])
    loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF)
    assert keys(spark, path) == [2, 3]


def test_files_that_hold_nothing_else_go_without_a_rewrite(spark, folder):
    path = f"{folder}/t"
    written(spark, path, [sale(1, 8)], [sale(2, 15)])
    kept = holder(spark, path, 2)
    loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF)
    assert names(path) == {kept}


class Lost(Exception):
    """The driver is lost."""


@pytest.mark.parametrize("step", ["complete_swap", "move", "remove"])
def test_a_lost_driver_leaves_what_the_next_run_completes(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    written(spark, path, [sale(1, 8), sale(2, 15)], [sale(3, 9), sale(4, 16)], [sale(5, 17)])
    real = swaps.all_at_once

    def fail(call, values):
        values = sorted(values)
        if call.__name__ == step:
            real(call, values[: len(values) // 2])
            raise Lost
        real(call, values)

    def lose(*_):
        raise Lost

    with monkeypatch.context() as patch, pytest.raises(Lost):
        patch.setattr(swaps, *(("complete_swap", lose) if step == "complete_swap" else ("all_at_once", fail)))
        loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF)
    # Whole but for what is moved already: no row is missing.
    assert {2, 4, 5} <= set(keys(spark, path))
    loads.expire_rows(spark, path, frame(spark).schema, "ts", AS_OF)
    assert keys(spark, path) == [2, 4, 5]
    assert swaps.finish_swaps(spark, path) == 0


def test_a_swap_that_is_not_whole_is_dropped(spark, folder):
    path = f"{folder}/t"
    written(spark, path, [sale(1, 15)])
    write_dataset(frame(spark, sale(9, 15)), f"{path}/_swaps/x/new", ["event_date"])
    assert keys(spark, path) == [1]
    assert swaps.finish_swaps(spark, path) == 0
    assert keys(spark, path) == [1] and not any(Path(path, "_swaps").iterdir())


def test_days_are_compacted_together_and_rows_that_land_meanwhile_stay(spark, folder, monkeypatch):
    path = f"{folder}/t"
    days = [DAY, dt.date(2024, 5, 11), dt.date(2030, 1, 1), None]
    for n, batch in enumerate(["a", "b"]):
        write_batch(frame(spark, sale(n, 8), sale(10 + n, 9, days[1]), (20 + n, None, None)), path, batch)
    before = rows(read_dataset(spark, path, SCHEMA))
    real = swaps.complete_swap

    def late(spark, path, swap):
        write_batch(frame(spark, sale(7, 7)), path, "late")
        real(spark, path, swap)

    monkeypatch.setattr(swaps, "complete_swap", late)
    loads.compact_days(spark, path, frame(spark).schema, days)
    assert rows(read_dataset(spark, path, SCHEMA).filter("k <> 7")) == before
    assert keys(spark, path) == sorted([0, 1, 7, 10, 11, 20, 21])
    found = {p.name for p in Path(path, f"event_date={DAY}").iterdir() if p.is_dir()}
    assert found == {f"batch=compact-{DAY}", "batch=late"}
    assert len(names(path)) == 4
    loads.compact_days(spark, path, frame(spark).schema, [dt.date(2031, 1, 1)])
    assert len(names(path)) == 4


def test_moved_files_keep_what_has_the_same_name(spark, folder):
    spark.range(4).selectExpr("id", "id % 2 part").coalesce(1).write.partitionBy("part").parquet(f"{folder}/all")
    assert [swaps.move_files(spark, f"{folder}/all/part={part}", f"{folder}/records") for part in (0, 1)] == [1, 1]
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/records").collect()) == [0, 1, 2, 3]
    assert swaps.move_files(spark, f"{folder}/all/part=0", f"{folder}/records") == 0
    assert swaps.move_files(spark, f"{folder}/missing", f"{folder}/records") == 0


def test_jobs_write_compact_files(spark, folder):
    use_settings(spark).range(10).write.parquet(f"{folder}/z")
    file = next(Path(f"{folder}/z").glob("*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
