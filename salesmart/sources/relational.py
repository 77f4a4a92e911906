"""Appending to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

BATCH_ROWS = 10_000


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    driver: str,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = BATCH_ROWS,
    connections: int = 16,
    mode: str = "append",
) -> None:
    """Append over JDBC with at most ``connections`` open at a time.

    Each task inserts in one transaction, so a failed task leaves nothing behind.
    A task whose commit succeeded but whose report was lost is run again and
    repeats its rows, as with any JDBC append: give the target table a key that
    ignores repeats, or load a day table with ``mode="overwrite"`` instead.
    ``overwrite`` empties the table and keeps its definition.
    """
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("driver", driver)
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .option("truncate", str(mode == "overwrite").lower())
        .options(**(properties or {}))
        .mode(mode)
        .save()
    )
