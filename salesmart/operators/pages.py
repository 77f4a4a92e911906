"""Result pages of an API: JSON objects with an array of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def flatten_pages(
    pages: DataFrame,
    item_type: str,
    max_pages: int | None = None,
    body: str = "body",
    page: str = "page",
    items: str = "results",
    lenient: bool = False,
    observe: Observation | str | None = None,
) -> DataFrame:
    """One row per item and its ``position``, with the other columns of its page.

    A page that is cut off, no JSON or without a body raises; when ``lenient`` it
    gives no rows, and ``observe`` counts the pages read and skipped. A page without
    the array gives no rows. Pages beyond ``max_pages``, where that is given, are
    dropped before they are parsed. ``item_type`` is the type of one item,
    ``STRING`` to keep it as JSON text.
    """
    kept = pages if max_pages is None else pages.filter(F.col(page) <= max_pages)
    others = [c for c in pages.columns if c != body]
    if lenient:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
        parsed = F.from_json(F.col(body), f"`{items}` ARRAY<{item_type}>, _broken STRING", options)
    else:
        text = F.coalesce(F.nullif(F.trim(body), F.lit("")), F.raise_error(F.lit("a page without a body")).cast("string"))
        parsed = F.from_json(text, f"`{items}` ARRAY<{item_type}>", {"mode": "FAILFAST"})
    kept = kept.select(*others, parsed.alias("_page"))
    if observe is not None:
        broken: Column = F.col("_page").isNull()
        if lenient:
            broken = broken | F.col("_page._broken").isNotNull()
        kept = kept.observe(observe, F.count(F.lit(1)).alias("read"), F.count_if(broken).alias("skipped"))
    return kept.select(*others, F.posexplode(f"_page.{items}").alias("position", "item"))


def union_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All pages as one set, matched by column name; copies are kept."""
    for other in others:
        first = first.unionByName(other)
    return first
