"""Plans and results when one key holds a third of all rows."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import executed_plan, plan, rows
from pyspark.sql import functions as F

from salesmart.operators.keys import enriched, last_per_key, upserted
from salesmart.operators.quality import repeated_keys
from salesmart.sources.lake import write_dataset

N = 300_000


@pytest.fixture
def small_partitions(spark):
    """AQE limits scaled down to test data, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark):
    """A third of the rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select(key.cast("bigint").alias("k"), "id", F.rand(1).alias("x"))


def stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_enrichment_splits_the_hot_key(spark, folder, small_partitions, how):
    listing = stored(skewed(spark), f"{folder}/l")
    details = stored(spark.range(0, N, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")), f"{folder}/d")
    joined = enriched(listing, details, ["k"], how)
    assert "skew=true" in executed_plan(joined)
    assert joined.agg(F.sum(F.col("y") - 2 * F.col("k")), F.count("y")).first()[:] == (0, N)


def test_upsert_splits_a_hot_table_key(spark, folder, small_partitions):
    table = stored(skewed(spark), f"{folder}/t")
    batch = spark.range(1, 1000).select(F.col("id").alias("k"), "id", F.lit(0.0).alias("x"))
    keys = stored(batch.select("k").distinct(), f"{folder}/k")
    merged = upserted(table, batch, ["k"], keys)
    assert "skew=true" in executed_plan(merged)
    replaced = len([i for i in range(1, 1000) if i % 3])
    assert merged.count() == N - replaced + 999


def test_hot_key_is_cut_before_the_shuffle(spark, folder):
    table = stored(skewed(spark), f"{folder}/t")
    last = last_per_key(table, ["k"], ["id"])
    text = plan(last)
    first_limit, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2 and exchange < first_limit
    assert last.filter("k = 0").first()["id"] == N - 3
    assert last.count() == N - N // 3 + 1


def test_checks_merge_copies_in_the_map_tasks(spark, folder):
    table = stored(skewed(spark), f"{folder}/t")
    text = plan(repeated_keys(table, ["k"]))
    assert "partial_count" in text
    assert rows(repeated_keys(table, ["k"])) == [(0, N // 3)]


def test_hot_partition_is_written_by_several_tasks(spark, folder, small_partitions):
    part = F.when(F.col("k") == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 4))
    write_dataset(skewed(spark).withColumn("p", part), f"{folder}/w", ["p"])
    files = list(Path(f"{folder}/w/p=hot").glob("*.parquet"))
    assert len(files) > 2
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == N // 3
