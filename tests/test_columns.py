import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.functions.documents import json_text, text_fields, typed
from salesmart.functions.times import (
    from_epoch_micros,
    from_epoch_millis,
    months_later,
    next_day,
    second_text,
    weekday_from_monday,
)
from salesmart.functions.values import dated_id, discounted_total, is_positive, row_key, within


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_text_fields_keep_json_text_of_any_value(spark):
    doc = '{"s": "x", "e": "", "n": 1.5, "b": true, "z": null, "o": {"k": [1, 2]}, "a": [{"id": 3}]}'
    keys = ["s", "e", "n", "b", "z", "o", "a", "missing"]
    df = spark.createDataFrame([(doc,)], "d STRING")
    found = df.select(text_fields(F.col("d"), keys).alias("f")).select("f.*").first()
    assert tuple(found) == ("x", "", "1.5", "true", None, '{"k":[1,2]}', '[{"id":3}]', None)


def test_document_that_is_not_json(spark):
    df = spark.createDataFrame([("{broken",)], "d STRING")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        df.select(text_fields(F.col("d"), ["a"])).collect()
    assert df.select(text_fields(F.col("d"), ["a"], lenient=True).alias("f")).first()["f"]["a"] is None


@pytest.mark.parametrize(
    ("kind", "good", "expected", "bad"),
    [
        ("date", "2024-02-29", dt.date(2024, 2, 29), "2024-02-30"),
        ("int", "12", 12, "12.5"),
        ("bigint", "3000000000", 3000000000, "x"),
        ("decimal(20,6)", "7.25", Decimal("7.250000"), "seven"),
        ("boolean", "true", True, "maybe"),
    ],
)
def test_typed(spark, kind, good, expected, bad):
    assert values(spark, "STRING", [good, "", None], lambda c: typed(c, kind)) == [expected, None, None]
    with pytest.raises(PySparkException):
        values(spark, "STRING", [bad], lambda c: typed(c, kind))
    assert values(spark, "STRING", [bad], lambda c: typed(c, kind, lenient=True)) == [None]


def test_text_keeps_the_empty_text(spark):
    assert values(spark, "STRING", ["", None], lambda c: typed(c, "string")) == ["", None]


def test_boolean_spellings(spark):
    words = ["t", "on", "YES", "1", "f", "off", "no", "0"]
    assert values(spark, "STRING", words, lambda c: typed(c, "boolean")) == [True] * 4 + [False] * 4


def test_json_text_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id INT, name STRING")
    assert df.select(json_text("id", "name")).first()[0] == '{"id":1,"name":null}'


def test_row_key(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 15), 7), (None, 7), (dt.date(2026, 3, 15), None)], "d DATE, m BIGINT")
    expected = hashlib.md5(b"2026-03-15-7").hexdigest()
    assert [r[0] for r in df.select(row_key("d", "m")).collect()] == [expected, None, None]


def test_dated_id(spark):
    day = dt.date(2026, 3, 15)
    numbers = [0, 7, 2**40 - 1, None]
    found = values(spark, "BIGINT", numbers, lambda c: dated_id(F.lit(day), c))
    base = (day - dt.date(1970, 1, 1)).days * 2**40
    assert found == [base, base + 7, base + 2**40 - 1, None]
    for number in (-1, 2**40):
        with pytest.raises(PySparkException, match="out of range"):
            values(spark, "BIGINT", [number], lambda c: dated_id(F.lit(day), c))


def test_ranges_and_flags(spark):
    assert values(spark, "INT", [0, 1, 5, 6, None], lambda c: within(c, 1, 5)) == [None, 1, 5, None, None]
    assert values(spark, "INT", [10, 0, -1, None], is_positive) == [True, False, False, False]


def test_discounted_total_is_exact_and_rounds_half_up(spark):
    data = [("1.50", 1, 30), ("0.05", 1, 10), ("0.15", 1, 50), ("1500.00", 10, 0), ("999999.99", 1000, 15)]
    df = spark.createDataFrame([(Decimal(p), q, d) for p, q, d in data], "p DECIMAL(10,2), q INT, d INT")
    found = [r[0] for r in df.select(discounted_total(F.col("p"), F.col("q"), F.col("d"))).collect()]
    assert found == [Decimal(v) for v in ("1.05", "0.05", "0.08", "15000.00", "849999991.50")]


def test_epochs(spark):
    moment = dt.datetime(2024, 5, 10, 14, 30, 0, 123456)
    micros = 1715351400123456
    assert values(spark, "BIGINT", [micros, None], lambda c: from_epoch_micros(c).cast("string")) == [
        str(moment), None,
    ]
    assert values(spark, "BIGINT", [micros // 1000], lambda c: from_epoch_millis(c).cast("string")) == [
        "2024-05-10 14:30:00.123"
    ]
    assert values(spark, "BIGINT", [micros], lambda c: second_text(from_epoch_micros(c))) == ["2024-05-10 14:30:00"]
    assert values(spark, "BIGINT", [-1], lambda c: F.to_date(from_epoch_micros(c))) == [dt.date(1969, 12, 31)]


def test_days_and_months(spark):
    days = [dt.date(2024, 2, 28), dt.date(2024, 12, 31)]
    assert values(spark, "DATE", days, next_day) == [dt.date(2024, 2, 29), dt.date(2025, 1, 1)]
    last = [dt.datetime(2024, 1, 31, 12)]
    assert values(spark, "TIMESTAMP", last, lambda c: months_later(c, 1)) == [dt.datetime(2024, 2, 29, 12)]
    week = [dt.date(2024, 4, 1) + dt.timedelta(days=i) for i in range(7)]
    assert values(spark, "DATE", week, weekday_from_monday) == [1, 2, 3, 4, 5, 6, 7]
