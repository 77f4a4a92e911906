"""Dropping rows by age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.times import moment_literal, months_later, surely_expired_until


def keep_recent(
    df: DataFrame,
    moment: str,
    as_of: dt.datetime,
    months: int = 1,
    only_where: Column | None = None,
) -> DataFrame:
    """The rows younger than ``months`` at ``as_of``; rows without a moment stay.

    With ``only_where``, an expired row is dropped only where that holds too.
    The first filter is implied by the second; it compares the bare column, so it
    reaches the scan and skips old files and row groups.
    """
    kind = df.schema[moment].dataType.simpleString()
    when = F.col(moment)
    # Not written as ``IS NULL OR``: Catalyst would merge it into the filter below.
    young = F.coalesce(months_later(when, months) > moment_literal(as_of, kind), F.lit(True))
    if only_where is not None:
        return df.filter(young | ~F.coalesce(only_where, F.lit(False)))
    floor = moment_literal(surely_expired_until(as_of, months), kind)
    return df.filter(when.isNull() | (when > floor)).filter(young)
