"""An index from keys to the dates that hold them, for tables by date whose key is no date.

The index is a table by ``bucket``, a hash of the key: which dates hold the keys of a
batch is read from the batch's buckets alone. It may name too many dates for a key,
never too few: a load notes its keys before it changes the table, and nothing is taken
out until the index is built again. So a load that fails leaves an index that is as
good as before. Whoever writes the table otherwise calls ``note_keys`` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from salesmart.operators.keys import same_key
from salesmart.session import folder_exists
from salesmart.sources.lake import read_dataset, write_dataset

BUCKET = "bucket"
BUCKETS = 256
# Spark leaves this file where a build was complete.
COMPLETE = "_SUCCESS"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def build_key_dates(
    table: DataFrame, path: str, keys: Sequence[str], date_column: str = "load_date", buckets: int = BUCKETS
) -> None:
    """The index of a whole table, in place of what is in ``path``; reads its key columns once."""
    rows = table.select(*keys, date_column).distinct().withColumn(BUCKET, bucket_of(keys, buckets))
    write_dataset(rows, path, [BUCKET], "overwrite", {"partitionOverwriteMode": "static"})


def key_dates(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], date_column: str) -> DataFrame:
    """The index with columns typed as those of ``rows``."""
    fields = [rows.schema[c] for c in (*keys, date_column)]
    schema = StructType([*(StructField(f.name, f.dataType) for f in fields), StructField(BUCKET, IntegerType())])
    return read_dataset(spark, path, schema)


def is_complete(spark: SparkSession, path: str) -> bool:
    return folder_exists(spark, f"{path}/{COMPLETE}")


def in_buckets(index: DataFrame, rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The index entries in the buckets of the keys of ``rows``: at most ``buckets`` numbers come to the driver."""
    found = [r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect()]
    return index.filter(F.col(BUCKET).isin(found))


def entries_of(index: DataFrame, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The index entries of the keys of ``rows``, which are distinct; NULL is a key like others."""
    some = in_buckets(index, rows, keys, buckets)
    return some.join(rows.select(*keys), same_key(some, rows, keys), "left_semi")


def note_keys(
    rows: DataFrame, path: str, keys: Sequence[str], date_column: str = "load_date", buckets: int = BUCKETS
) -> None:
    """Add the keys and dates of ``rows`` that the index does not name yet. Can be run again."""
    pairs = rows.select(*keys, date_column).distinct()
    index = key_dates(rows.sparkSession, path, rows, keys, date_column)
    some = in_buckets(index, pairs, keys, buckets)
    fresh = pairs.join(some, same_key(pairs, some, [*keys, date_column]), "left_anti")
    write_dataset(fresh.withColumn(BUCKET, bucket_of(keys, buckets)), path, [BUCKET])
