"""Loads into several tables that readers see together or not at all.

Rows carry the name of their load as a partition, and readers take the loads that
are published. Publishing is one small file, created when all tables are written, so
the rows of all of them appear at one moment; a load that failed half way is never seen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from salesmart.session import folder_exists, remove_folder
from salesmart.sources.lake import read_dataset, write_dataset

LOAD = "load"
PUBLISHED = "published"


def published_loads(spark: SparkSession, register: str) -> list[str]:
    """The names of the published loads, of which there are as many as loads were run."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(register)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(n.removesuffix(f".{PUBLISHED}") for n in names if n.endswith(f".{PUBLISHED}") and not n.startswith("."))


def publish(spark: SparkSession, register: str, load: str) -> None:
    """Make the rows of a load visible in all tables."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{register}/{load}.{PUBLISHED}")
    file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file, True).close()


def withdraw(spark: SparkSession, register: str, load: str) -> None:
    """Hide the rows of a load again, in all tables at once."""
    remove_folder(spark, f"{register}/{load}.{PUBLISHED}")


def load_published(
    batches: Mapping[str, DataFrame], register: str, load: str, partition_by: Sequence[str] = ("load_date",)
) -> bool:
    """Write several batches, ``{table path: batch}``, as one load and publish it.

    Returns whether it was written: a load that is published already is left as it is.
    One that failed before it was published removes what it left and writes again.
    """
    if not load or "/" in load or load.startswith((".", "_")):
        raise ValueError(f"{load!r} names no load")
    spark = next(iter(batches.values())).sparkSession
    if load in published_loads(spark, register):
        return False
    for path, batch in batches.items():
        folder = f"{path}/{LOAD}={load}"
        remove_folder(spark, folder)
        write_dataset(batch, folder, partition_by)
    publish(spark, register, load)
    return True


def read_published(
    spark: SparkSession, path: str, schema: str | StructType, register: str, with_load: bool = False
) -> DataFrame:
    """The rows of the published loads; only their folders are listed and read."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [*schema.names, LOAD] if with_load else schema.names
    whole = StructType([*schema.fields, StructField(LOAD, StringType())])
    folders = [f"{path}/{LOAD}={load}" for load in published_loads(spark, register)]
    folders = [f for f in folders if folder_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], whole).select(*columns)
    return spark.read.schema(whole).option("basePath", path).parquet(*folders).select(*columns)
