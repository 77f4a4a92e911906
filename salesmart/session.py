"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"

# What the jobs rely on. All times are UTC; AQE splits skewed joins and
# rebalanced writes, so no job names a shuffle width.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A small write of very many dates still takes all cores: it waits for files, not for rows.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Change records are JSON text: several times smaller than with the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
}

# For jobs on a cluster: shuffles start wide, and AQE merges what is small. It cannot
# split an aggregate or a range write, so the width bounds what a task of those gets.
WIDE = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


def build_session(
    app_name: str = "salesmart",
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
    **more: str,
) -> SparkSession:
    """A session with the settings the jobs rely on, ``settings`` and ``more``, which uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    for key, value in more.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, so epoch values and dates do not depend on the host."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_settings(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the settings the jobs rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that is not set, as in tests, a folder in the warehouse is set.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_working"
        spark.conf.set(CHECKPOINT_SETTING, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def sparing_disk(spark: SparkSession, writers: int = 0) -> Iterator[None]:
    """What is run in here deletes its shuffle files at its end, not when the driver
    happens to collect its garbage. With ``writers``, a task writes to so many partitions
    of a table at once; it would sort its rows otherwise, and spill them. That is for
    partitions of which there are few.
    """
    settings = {CLEANUP_SETTING: "true", WRITERS_SETTING: str(writers)}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a file, or of all files in a folder; 0 where there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store its address names; a missing one is fine."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
