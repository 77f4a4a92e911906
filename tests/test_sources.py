import datetime as dt
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from salesmart import session
from salesmart.plans import sales as model
from salesmart.sources import relational
from salesmart.sources.kafka import kafka_changes
from salesmart.sources.lake import read_dataset, read_day, write_dataset


def lake(spark, folder):
    schema = "id BIGINT, region STRING, event_date DATE"
    days = [dt.date(2024, 5, d) for d in (1, 2, 3)]
    data = [(i, ["EU", "007", None][i % 3], days[i // 3 % 3]) for i in range(90)]
    write_dataset(spark.createDataFrame(data, schema), f"{folder}/lake")
    return f"{folder}/lake", schema, data


def test_round_trip_keeps_types_and_null_partitions(spark, folder):
    path, schema, data = lake(spark, folder)
    assert rows(read_dataset(spark, path, schema)) == sorted(data, key=repr)


def test_one_day_reads_its_partitions_only(spark, folder):
    path, schema, data = lake(spark, folder)
    day = dt.date(2024, 5, 2)
    df = read_day(spark, path, day, schema)
    assert rows(df) == sorted([r for r in data if r[2] == day], key=repr)
    # The day's folder is all that is listed, and a count opens no column.
    assert all("event_date=2024-05-02" in file for file in df.inputFiles())
    assert "ReadSchema: struct<>" in plan(df.agg(F.count(F.lit(1))))
    assert read_day(spark, path, dt.date(2024, 6, 1), schema).collect() == []


def test_jdbc_options():
    df = MagicMock()
    chain = df.write.format.return_value
    chain.option.return_value = chain.options.return_value = chain.mode.return_value = chain
    relational.append_jdbc(df, "jdbc:x", "t", "driver.D", {"user": "u"}, connections=4)
    df.write.format.assert_called_once_with("jdbc")
    options = {c.args[0]: c.args[1] for c in chain.option.call_args_list}
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "driver": "driver.D", "batchsize": 10_000, "numPartitions": 4,
        "truncate": "false",
    }
    chain.options.assert_called_once_with(user="u")
    chain.mode.assert_called_once_with("append")
    chain.save.assert_called_once_with()


def test_kafka_options():
    reader = MagicMock()
    reader.option.return_value = reader.options.return_value = reader
    fake = SimpleNamespace(readStream=SimpleNamespace(format=MagicMock(return_value=reader)))
    kafka_changes(fake, "host:1", "topic", max_offsets_per_trigger=1000, min_partitions=64, options={"a": "b"})
    fake.readStream.format.assert_called_once_with("kafka")
    assert {c.args[0]: c.args[1] for c in reader.option.call_args_list} == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "topic", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": 1000, "minPartitions": 64,
    }
    reader.options.assert_called_once_with(a="b")
    reader.load.return_value.select.assert_called_once_with("value", "timestamp")


def fake_session(**settings):
    known = {key.replace("__", "."): value for key, value in settings.items()}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: known.get(key, default), set=known.__setitem__),
        sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: None)),
    )


def test_working_folder():
    shared = fake_session(spark__checkpoint__dir="hdfs://shared/checkpoints/")
    one, two = session.working_folder(shared, "x"), session.working_folder(shared, "x")
    assert one.startswith("hdfs://shared/checkpoints/x-") and one != two
    unset = fake_session(spark__sql__warehouse__dir="hdfs://shared/warehouse")
    assert session.working_folder(unset, "x").startswith("hdfs://shared/warehouse/_working/x-")
    assert unset.conf.get("spark.checkpoint.dir") == "hdfs://shared/warehouse/_working"


def test_utc(spark):
    session.use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.timestamp_micros(F.lit(0)).cast("string")).first()[0] == "1970-01-01 00:00:00"


def test_lake_schema_names_the_partitions_last():
    names = [c.split(" ")[0] for c in model.LAKE_SCHEMA.split(", ")]
    assert (names[-1],) == model.PARTITIONS
