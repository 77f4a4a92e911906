"""Keys, flags and amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by ``-``; NULL as soon as one part is NULL."""
    texts: list[Column] = []
    for part in parts:
        column = F.col(part) if isinstance(part, str) else part
        texts += [F.lit("-"), column.cast("string")]
    return F.md5(F.concat(*texts[1:]))


def dated_id(day: Column, number: Column, bits: int = 40) -> Column:
    """A whole number that is unique for the day and the number, the same on every run.

    The number takes the lower ``bits``; one that does not fit raises.
    """
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint")
    too_large = F.raise_error(F.concat(F.lit("id out of range: "), number.cast("string"))).cast("bigint")
    return F.when(number.between(0, 2**bits - 1), days * 2**bits + number).when(number.isNotNull(), too_large)


def within(value: Column, low: int, high: int) -> Column:
    """The value where it lies in the range, else NULL."""
    return F.when(value.between(low, high), value)


def is_positive(value: Column) -> Column:
    """True above zero, false otherwise, also for NULL."""
    return F.coalesce(value > 0, F.lit(False))


def discounted_total(price: Column, quantity: Column, discount_pct: Column, precision: int = 12) -> Column:
    """``price * quantity`` less the discount, rounded once, half up, to cents.

    Prices and discounts count to four places, quantities to three; nothing is
    rounded before the product.
    """
    gross = price.cast("decimal(14,4)") * quantity.cast("decimal(10,3)")
    kept = (F.lit(100) - discount_pct.cast("decimal(7,4)")) * F.lit(Decimal("0.01"))
    return F.round(gross * kept, 2).cast(f"decimal({precision},2)")
