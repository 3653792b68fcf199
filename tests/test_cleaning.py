from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from ordermill.plans.cleaning import (
    ItemRules, clean_calendar, clean_options, clean_order_items, item_stage_counts, option_stage_counts,
)
from ordermill.schemas import RAW_CALENDAR
from tests.rows import raw_item, raw_items, raw_option, raw_options

RULES = ItemRules(excluded_apps=("Test App",), excluded_restaurants=("R9",))


@pytest.mark.parametrize("change, kept", [
    ({}, True),
    ({"APP_NAME": "Test App"}, False), ({"APP_NAME": None}, False),
    ({"RESTAURANT_ID": "R9"}, False), ({"RESTAURANT_ID": None}, False),
    ({"ITEM_CATEGORY": "Test Items"}, False), ({"ITEM_CATEGORY": None}, True),
    ({"ORDER_ID": None}, False), ({"LINEITEM_ID": None}, False),
    ({"ITEM_PRICE": Decimal("50.00")}, True), ({"ITEM_PRICE": Decimal("50.01")}, False),
    ({"ITEM_PRICE": Decimal("-0.01")}, False), ({"ITEM_PRICE": None}, False), ({"ITEM_PRICE": Decimal("0")}, True),
    ({"ITEM_QUANTITY": 0}, False), ({"ITEM_QUANTITY": 1}, True), ({"ITEM_QUANTITY": 20}, True),
    ({"ITEM_QUANTITY": 21}, False), ({"ITEM_QUANTITY": None}, False),
    ({"CREATION_TIME_UTC": "nope"}, True), ({"USER_ID": None}, True),
])
def test_item_filters(spark, change, kept):
    assert clean_order_items(raw_items(spark, raw_item(**change)), RULES).count() == int(kept)


def test_item_columns(spark):
    rows = [
        raw_item(LINEITEM_ID="a", CREATION_TIME_UTC="2024-02-21T23:11:12.345Z", ITEM_QUANTITY=3),
        raw_item(LINEITEM_ID="b", CREATION_TIME_UTC="nope", USER_ID=None, ITEM_PRICE=Decimal("0"), IS_LOYALTY="x"),
        raw_item(LINEITEM_ID="c", ITEM_CATEGORY=None),
    ]
    a, b, c = clean_order_items(raw_items(spark, *rows), RULES, "now").orderBy("LINEITEM_ID").collect()
    assert (a.order_date, a.order_hour, a.line_item_revenue, a.IS_LOYALTY) == (date(2024, 2, 21), 23, Decimal("15.00"), True)
    assert (b.order_date, b.is_anonymous, b.is_zero_price_flag, b.IS_LOYALTY) == (None, True, True, None)
    assert (c.ITEM_CATEGORY, c.silver_ingestion_ts) == ("Unknown", "now")


def test_equal_keys_leave_the_smallest_row(spark):
    rows = [raw_item(ITEM_PRICE=Decimal(p), USER_ID=u) for p, u in (("7", "u2"), ("3", "u1"), ("9", None), ("8", None))]
    for order in (rows, rows[::-1]):
        kept = clean_order_items(raw_items(spark, *order), RULES).collect()
        assert [(r.USER_ID, r.ITEM_PRICE) for r in kept] == [(None, Decimal("8.00"))]


def test_item_counts(spark):
    raw = raw_items(
        spark, raw_item(), raw_item(ITEM_PRICE=Decimal("6")), raw_item(APP_NAME="Test App"), raw_item(ORDER_ID=None),
        raw_item(LINEITEM_ID="z", ITEM_QUANTITY=99))
    counts = item_stage_counts(raw, RULES).orderBy("step").collect()
    assert [(r.stage, r.rows_left, r.rows_removed) for r in counts] == [
        ("input", 5, 0), ("after_test_data", 4, 1), ("after_null_keys", 3, 1), ("after_outliers", 2, 1),
        ("after_dedupe", 1, 1)]
    assert counts[-1].retained_pct == Decimal("20.00")
    seen = Observation("items")
    clean_order_items(raw, RULES, observation=seen).collect()
    assert seen.get == {"rows_in": 5, "after_test_data": 4, "after_null_keys": 3, "after_outliers": 2}


def test_options(spark):
    raw = raw_options(
        spark, raw_option(OPTION_GROUP_NAME="MILK", OPTION_PRICE=Decimal("2")), raw_option(OPTION_GROUP_NAME="CT milk"),
        raw_option(OPTION_NAME=" oat "), raw_option(OPTION_NAME="free", OPTION_PRICE=Decimal("0")),
        raw_option(OPTION_NAME="bad", OPTION_PRICE=Decimal("-1")), raw_option(OPTION_NAME="none", OPTION_QUANTITY=0),
        raw_option(OPTION_NAME=None), raw_option(OPTION_GROUP_NAME=None))
    kept = clean_options(raw).orderBy("OPTION_NAME").collect()
    assert [(r.OPTION_GROUP_NAME, r.OPTION_NAME, r.option_revenue, r.is_paid_option) for r in kept] == [
        ("Milk", "free", Decimal("0.00"), False), ("Milk", "oat", Decimal("1.00"), True)]
    assert [r.rows_left for r in option_stage_counts(raw).orderBy("step").collect()] == [8, 6, 4, 2]


def test_calendar(spark):
    raw = spark.createDataFrame([
        ("31-12-2023", "2023", "12", "52", "Sunday", " t ", "no", "  "),
        ("32-01-2023", "2023", "1", "1", "x", "TRUE", "TRUE", None),
        ("2023-12-31", "2023", "12", "52", "x", "TRUE", "TRUE", None),
        (None, "2023", "12", "52", "x", "TRUE", "TRUE", None),
        ("04-09-2023", "?", "9", "36", "Monday", "FALSE", "perhaps", " Labor Day "),
    ], RAW_CALENDAR)
    a, b = clean_calendar(raw).orderBy("date_key").collect()
    assert (a.date_key, a.date_key_raw, a.year, a.is_holiday, a.holiday_name) == (
        date(2023, 9, 4), "04-09-2023", None, None, "Labor Day")
    assert (b.date_key, b.week, b.is_weekend, b.is_holiday, b.holiday_name) == (date(2023, 12, 31), 52, True, False, None)
