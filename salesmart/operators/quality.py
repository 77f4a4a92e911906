"""Checks on keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that miss a value, per column, counted in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys held by more than one row, with their row count; NULL keys are not compared."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_report(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """One row per check with the number of failures: rows for ``not_null``, keys for ``unique``.

    One pass over the table: each row gives one entry per check, with the value
    for ``unique`` and only whether there is one for ``not_null``. Entries are
    counted in the map tasks first.
    """
    checks = [("not_null", c) for c in not_null] + [("unique", c) for c in unique]
    if not checks:
        raise ValueError("no checks given")

    def entry(place: int, check: str, column: str) -> Column:
        value = F.col(column).cast("string")
        seen = value if check == "unique" else F.when(value.isNotNull(), F.lit(""))
        return F.struct(F.lit(place).alias("place"), seen.alias("value"))

    entries = df.select(F.inline(F.array(*[entry(i, *check) for i, check in enumerate(checks)])))
    counted = entries.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n"))
    absent, repeated = F.col("value").isNull(), F.col("value").isNotNull() & (F.col("n") > 1)
    found = counted.groupBy("place").agg(
        F.sum(F.when(absent, F.col("n"))).alias("absent"), F.count_if(repeated).alias("repeated")
    )
    named = df.sparkSession.createDataFrame(
        [(i, *check) for i, check in enumerate(checks)], "place INT, check STRING, column_name STRING"
    )
    failures = F.coalesce(F.when(F.col("check") == "unique", F.col("repeated")).otherwise(F.col("absent")), F.lit(0))
    return named.join(found, "place", "left").select("check", "column_name", failures.alias("failures"))


def require(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> None:
    """Raise when a check fails."""
    failed = check_report(df, not_null, unique).filter("failures > 0").collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']}({r['column_name']}): {r['failures']}" for r in failed))
