"""Written tables that cut lineage, global positions, and bitmaps of bounded size."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARED_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Of what a task hands to Python at once in a lean workspace, unless the session says otherwise.
BATCH_BYTES = 2 << 20
SLICE_BITS = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    root = spark.conf.get(SHARED_SETTING, None) or spark.sparkContext.getConf().get(SHARED_SETTING)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_working"
        spark.conf.set(SHARED_SETTING, root)
    return root.rstrip("/")


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the executors, wherever the driver imported it from.

    The archive is a file of the driver, which serves it, once per application.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="package-")
    archive = Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """What is run in here deletes its shuffle files at its end, not when the driver
    happens to collect its garbage, and hands small batches to Python: at most about
    ``BATCH_BYTES`` and one row, however many rows there are."""
    before = {name: spark.conf.get(name, None) for name in (CLEANUP_SETTING, BATCH_SETTING)}
    spark.conf.set(CLEANUP_SETTING, "true")
    if before[BATCH_SETTING] is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Workspace:
    """Tables of one run in the shared folder. A lost executor costs no table.

    lean: the shuffle files of a table go as soon as it is written, and Python gets
    small batches."""

    def __init__(self, spark: SparkSession, purpose: str, lean: bool = False):
        ship_package(spark)
        self.spark = spark
        self.lean = lean
        self.root = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        with lean(self.spark) if self.lean else nullcontext():
            df.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def path(self, name: str) -> str:
        """Where a table or set of files of this run belongs."""
        return f"{self.root}/{name}"

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more; without names, all."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names or ("",):
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            folder.getFileSystem(conf).delete(folder, True)


def ranked(work: Workspace, df: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """The rows with ``position``, their place from 0 in the given order.

    Rows are range-partitioned and sorted where they are; a row's place is its
    place in its partition plus the sizes of the partitions before it. Of these
    there is one row a partition, which is the bound of the broadcast.
    """
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = work.stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        name,
    )
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("position", F.col("_before") + within)
        .drop("_part", "_place", "_before")
    )


def bitmap(cells: DataFrame, bits: int) -> np.ndarray:
    """``2**bits`` bits as bytes, with the bits set whose numbers are in the only column.

    Spark packs slices of 2**16 bits; the driver gets 2**bits / 8 bytes at most,
    however many rows there are.
    """
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << SLICE_BITS, np.uint8)
        flags[group["bit"].to_numpy()] = 1
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "packed": [np.packbits(flags).tobytes()]})

    slices = (
        cells.toDF("cell")
        .select(
            F.shiftright(F.col("cell").cast("long"), SLICE_BITS).cast("int").alias("slice"),
            F.col("cell").cast("long").bitwiseAND(F.lit((1 << SLICE_BITS) - 1)).cast("int").alias("bit"),
        )
        .distinct()
        .groupBy("slice")
        .applyInPandas(pack, "slice int, packed binary")
    )
    packed = np.zeros(max(1 << bits, 1 << SLICE_BITS) // 8, np.uint8)
    width = (1 << SLICE_BITS) // 8
    for row in slices.toLocalIterator():
        packed[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["packed"], np.uint8)
    return packed


def bit_set(packed: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which of the numbered bits are set."""
    cells = cells.astype(np.int64)
    return (packed[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
