from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.functions.dates import calendar_parts, hour_bucket, iso_year, order_date_parts
from ordermill.functions.labels import churn_tag, rfm_segment
from ordermill.functions.numbers import integer_key, magnitude_bucket, money_percent, percent, ratio
from ordermill.functions.text import blank_to_null, text_to_bool, tidy_category, tidy_option_group


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize("raw, clean", [
    (None, "Unknown"), ("", "Unknown"), ("   ", "Unknown"),
    ("BBQ Plateshttps://x.example/a", "BBQ Plates"), ("Bowls0", "Bowls"), ("Sandwiches`1 ", "Sandwiches"),
    ("  Sandwiches", "Sandwiches"), ("Drip Chttps://x.example/offee", "Drip Coffee"), ("Sqalads", "Salads"),
    ("Kids", "Kid's"), ("Kid'shttps://x.example", "Kid's"), (" Soups ", "Soups"), ("Drip Cold", "Drip Cold"),
])
def test_category(spark, raw, clean):
    assert values(spark, [raw], tidy_category) == [clean]


def test_option_group(spark):
    raw = ["BOTTLE DEPOSIT", "bottle deposit ", "CT Bacon Egg", "ct  Bacon Egg", "ADD-ONS", "CTX", None]
    assert values(spark, raw, tidy_option_group) == [
        "Bottle Deposit", "Bottle Deposit", "Bacon Egg", "Bacon Egg", "Add-ons", "Ctx", None]


def test_booleans(spark):
    raw = ["TRUE", "true", "FALSE", "yes", " TRUE", None]
    assert values(spark, raw, text_to_bool) == [True, True, False, None, None, None]
    raw = [" t ", "1", "Yes", "y", "F", "0", "no", "N", "maybe", None]
    assert values(spark, raw, lambda c: text_to_bool(c, wide=True)) == [True] * 4 + [False] * 4 + [None, None]


def test_blank(spark):
    assert values(spark, ["", "  ", " Labor Day ", None], blank_to_null) == [None, None, "Labor Day", None]


def test_ratios_round_half_up(spark):
    line = spark.range(1).select(
        ratio(F.lit(1), F.lit(8), 2), ratio(F.lit(Decimal("10.00")), F.lit(3)), ratio(F.lit(5), F.lit(0)),
        percent(F.lit(1), F.lit(2000), 1), ratio(F.lit(-1), F.lit(8), 2),
        money_percent(F.lit(Decimal("-3.00")), F.lit(Decimal("16.00")), 1),
    ).first()
    assert [None if v is None else str(v) for v in line] == ["0.13", "3.33", None, "0.10", "-0.13", "-18.80"]


def test_bucket_keeps_order(spark):
    numbers = sorted({s * (m * 2**e + d) for s in (1, -1) for e in range(0, 60, 3) for m in (1, 3) for d in (0, 1, 5)})
    buckets = values(spark, numbers, lambda c: magnitude_bucket(c), "bigint")
    assert buckets == sorted(buckets)
    # Buckets are fine: values that differ by a factor of two never share one.
    assert all(b != c for (x, b), (y, c) in zip(zip(numbers, buckets), zip(numbers[1:], buckets[1:])) if abs(y) >= 2 * abs(x) > 0)
    assert values(spark, [Decimal("1.25"), None], lambda c: integer_key(c, 2), "decimal(10,2)") == [125, None]


def test_dates(spark):
    parts = order_date_parts(F.col("v"))
    df = spark.createDataFrame([(date(2023, 1, 1),)], "v date")
    assert tuple(df.select(*parts.values(), iso_year(F.col("v"))).first()) == (2023, 1, 52, "2023-01", 2022)
    day = df.select(*[c.alias(n) for n, c in calendar_parts(F.col("v")).items()]).first()
    assert (day.day_of_week, day.day_name, day.is_weekend) == (1, "Sunday", True)
    assert values(spark, [0, 5, 6, 11, 12, 17, 18, 23, None], hour_bucket, "int") == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", None]


def test_labels(spark):
    assert values(spark, [30, 31, 45, 46, 60, 61], lambda d: churn_tag(d, (30, 45, 60)), "int") == [
        "Active", "Cooling Off", "Cooling Off", "At Risk", "At Risk", "Inactive"]
    scores = [(4, 4, 4), (1, 4, 3), (1, 1, 4), (4, 2, 3), (2, 3, 1), (2, 2, 2), (3, 3, 3)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(scores)], "i int, r int, f int, m int").orderBy("i")
    found = [x[0] for x in df.select(rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert found == ["VIP", "Loyal", "Big Spender", "New Customer", "At Risk", "Churn Risk", "Regular"]
