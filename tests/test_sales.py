import base64
import datetime as dt
import json
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from helpers import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from salesmart.plans import sales as model


def amount(cents: int) -> str:
    return base64.b64encode(cents.to_bytes(cents.bit_length() // 8 + 1, "big", signed=True)).decode()


def image(**changes):
    row = {
        "id": 1, "order_id": "a", "customer_id": 5, "product_id": 6, "product_name": "lamp",
        "category": "home", "quantity": 2, "unit_price": amount(1050), "discount_pct": 10,
        "total_price": amount(1890), "region": "EU", "city": "Rome", "payment_method": "paypal",
        "channel": "web", "is_returned": False, "rating": 4, "created_at": 1715351400123456,
    }
    return row | changes


def envelope(op="c", before=None, after=True, **changes):
    return {"before": before, "after": image(**changes) if after else None, "op": op, "ts_ms": 1715351400500}


def records(spark, texts):
    when = dt.datetime(2024, 5, 10, 15)
    data = [(None if t is None else bytearray(t.encode()), when) for t in texts]
    return spark.createDataFrame(data, "value BINARY, timestamp TIMESTAMP")


def wrapped(event):
    return json.dumps({"schema": {"type": "struct"}, "payload": event})


def test_decoded_row(spark):
    row = model.decode_changes(records(spark, [wrapped(envelope())])).first().asDict()
    assert row["unit_price"] == Decimal("10.50") and row["total_price"] == Decimal("18.90")
    assert row["event_time"] == dt.datetime(2024, 5, 10, 14, 30, 0, 123456)
    assert row["event_date"] == dt.date(2024, 5, 10)
    assert row["cdc_ts"] == dt.datetime(2024, 5, 10, 14, 30, 0, 500000)
    assert row["ingest_ts"] == dt.datetime(2024, 5, 10, 15)
    assert (row["cdc_op"], row["has_discount"], row["is_returned"], row["rating"]) == ("c", True, False, 4)
    lake = spark.createDataFrame([], model.LAKE_SCHEMA).schema
    decoded = model.decode_changes(records(spark, [])).schema
    assert {f.name: f.dataType for f in decoded} == {f.name: f.dataType for f in lake}


def test_time_as_text(spark):
    row = model.decode_changes(records(spark, [wrapped(envelope())]), time_as_text=True).first()
    assert row["event_time"] == "2024-05-10 14:30:00"


def test_every_envelope_shape_is_read(spark):
    texts = [
        wrapped(envelope(id=1)),
        json.dumps(envelope(id=2)),
        json.dumps({"payload": json.dumps(envelope(id=3))}),
        wrapped(envelope(id=4, op="r")),
    ]
    assert [r["id"] for r in model.decode_changes(records(spark, texts)).orderBy("id").collect()] == [1, 2, 3, 4]


def test_what_is_dropped_is_counted(spark):
    texts = [
        wrapped(envelope(id=1)),
        wrapped(envelope(op="u", before=image(id=2), id=2)),
        wrapped(envelope(op="d", before=image(id=3), after=False)),
        wrapped(envelope(id=None)),
        "{broken",
        '{"payload": null}',
        "",
        None,
    ]
    seen = Observation()
    decoded = model.decode_changes(records(spark, texts), observe=seen)
    assert [r["id"] for r in decoded.collect()] == [1]
    assert seen.get == {"read": 8, "kept": 1}


def test_row_before_the_change(spark):
    texts = [wrapped(envelope(op="u", before=image(id=2))), wrapped(envelope())]
    found = model.parse_changes(records(spark, texts), with_before=True).select("event.before").collect()
    assert [r[0] and json.loads(r[0])["id"] for r in found] == [2, None]


def test_null_fields(spark):
    texts = [wrapped(envelope(discount_pct=None, unit_price=None, rating=None, created_at=None, region=None))]
    row = model.decode_changes(records(spark, texts)).first()
    assert row["has_discount"] is False
    assert [row[c] for c in ("discount_pct", "unit_price", "rating", "event_time", "event_date", "region")] == [None] * 6


def test_same_rows_as_two_parses_after_another(spark):
    """The payload cut out as text and then parsed, on records that are all wrapped."""
    texts = [wrapped(envelope(op=op, id=i, rating=i % 7)) for i, op in enumerate("crudcrud" * 5)]
    texts += ['{"payload": {"op": "c", "after": {"id": "x", "rating": 3}}}', '{"payload": [1]}', "[]", "7"]
    found = model.first_images(model.parse_changes(records(spark, texts))).select("op", "ts_ms", "after")
    cut = F.get_json_object(F.col("value").cast("string"), "$.payload")
    parsed = records(spark, texts).select(F.from_json(cut, model.ENVELOPE).alias("e"))
    expected = parsed.filter("e.op IN ('c', 'r') AND e.after.id IS NOT NULL").select("e.op", "e.ts_ms", "e.after")
    assert rows(found) == rows(expected) and found.count() == 20


def test_decode_parses_once_and_starts_no_python(spark):
    text = plan(model.decode_changes(records(spark, [wrapped(envelope())]).repartition(2)))
    assert "Filter" not in text.replace("filter(", "")
    assert "Python" not in text


def sample(spark, n=4000):
    """Sales with a third of all rows in one group and replays of orders."""
    data = []
    for i in range(n):
        hot = i % 3 == 0
        data.append(
            (
                i, f"o{i // 2}", i % 11, Decimal(i * 37 % 9973).scaleb(-2), i % 9 if i % 5 else None,
                i % 4 == 0, i % 3 != 1, "crud"[i % 4] if not hot else "c",
                "EU" if hot else f"R{i % 5}", "home" if hot else f"k{i % 7}",
                dt.date(2024, 5, 1) if hot else dt.date(2024, 5, 1 + i % 3),
            )
        )
    return data, spark.createDataFrame(
        data,
        "id BIGINT, order_id STRING, quantity INT, total_price DECIMAL(10,2), rating INT, is_returned BOOLEAN, "
        "has_discount BOOLEAN, cdc_op STRING, region STRING, category STRING, event_date DATE",
    ).withColumns({"cdc_ts": F.lit(None), "ingest_ts": F.lit(None)})


def half_up(value: Fraction) -> float:
    cents = Decimal(value.numerator * 1000) / Decimal(value.denominator)
    return float((cents / 1000).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_daily_mart_against_brute_force(spark):
    data, df = sample(spark)
    groups = defaultdict(list)
    for row in data:
        if row[7] in "cr":
            groups[(row[10], row[8], row[9])].append(row)
    expected = []
    for key, members in groups.items():
        n = len(members)
        rated = [r[4] for r in members if r[4] is not None and 1 <= r[4] <= 5]
        total = sum(r[3] for r in members)
        returned = sum(r[5] for r in members)
        expected.append(
            (
                *key, n, len({r[1] for r in members}), sum(r[2] for r in members), total,
                half_up(Fraction(total) / n), half_up(Fraction(sum(rated), len(rated))) if rated else None,
                returned, half_up(Fraction(100 * returned, n)), sum(r[6] for r in members),
            )
        )
    assert rows(model.daily_mart(model.staged_sales(df))) == sorted(expected, key=repr)


def test_group_without_valid_ratings(spark):
    _, df = sample(spark, 30)
    mart = model.daily_mart(model.staged_sales(df.withColumn("rating", F.lit(9))))
    assert {r["avg_rating"] for r in mart.collect()} == {None}


def test_mart_order(spark):
    _, df = sample(spark)
    found = [(r["event_date"], r["total_revenue"]) for r in model.daily_mart(model.staged_sales(df), True).collect()]
    assert found == sorted(found, reverse=True)


def test_staging_columns(spark):
    staged = model.staged_sales(spark.createDataFrame([], model.LAKE_SCHEMA))
    assert {"valid_rating", "region", "event_date"} <= set(staged.columns)
    assert not {"cdc_op", "cdc_ts", "ingest_ts"} & set(staged.columns)


def test_mart_reads_only_its_columns_through_the_staging_layer(spark, folder):
    spark.createDataFrame([], model.LAKE_SCHEMA).write.parquet(f"{folder}/lake")
    lake = spark.read.schema(model.LAKE_SCHEMA).parquet(f"{folder}/lake")
    text = plan(model.daily_mart(model.staged_sales(lake)))
    assert "unit_price" not in text and "payment_method" not in text
    assert "PushedFilters: [In(cdc_op, [c,r])]" in text
