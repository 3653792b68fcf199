"""Small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import RAW_ITEMS, RAW_OPTIONS


def raw_item(**changes):
    row = dict(
        APP_NAME="Shop", RESTAURANT_ID="R1", CREATION_TIME_UTC="2024-02-21T10:11:12Z", ORDER_ID="o1", USER_ID="u1",
        PRINTED_CARD_NUMBER=None, IS_LOYALTY="TRUE", CURRENCY="USD", LINEITEM_ID="l1", ITEM_CATEGORY="Soups",
        ITEM_NAME="Soup", ITEM_PRICE=Decimal("5.00"), ITEM_QUANTITY=1)
    row.update(changes)
    return row


def raw_items(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame([tuple(r[n] for n in RAW_ITEMS.names) for r in rows], RAW_ITEMS)


def raw_option(**changes):
    row = dict(ORDER_ID="o1", LINEITEM_ID="l1", OPTION_GROUP_NAME="Milk", OPTION_NAME="oat",
               OPTION_PRICE=Decimal("1.00"), OPTION_QUANTITY=1)
    row.update(changes)
    return row


def raw_options(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame([tuple(r[n] for n in RAW_OPTIONS.names) for r in rows], RAW_OPTIONS)


def fact(spark: SparkSession, *rows) -> DataFrame:
    """Orders from (order_id, user_id, day, revenue) with optional loyalty, location and paid options."""
    lines = []
    for order_id, user_id, day, revenue, *more in rows:
        loyal, place, paid = [*more, *([False, "R1", 0][len(more):])]
        lines.append((order_id, user_id, place, date.fromisoformat(day), datetime.fromisoformat(day), Decimal(revenue),
                      loyal, paid))
    schema = ("order_id string, user_id string, restaurant_id string, order_date date, order_datetime timestamp, "
              "total_revenue decimal(18,2), is_loyalty boolean, paid_option_count bigint")
    return spark.createDataFrame(lines, schema).withColumns({
        "is_anonymous": F.col("user_id").isNull(), "has_paid_options": F.col("paid_option_count") > 0,
        "total_option_revenue": F.lit(0).cast("decimal(18,2)"),
        "order_year": F.year("order_date"), "order_month": F.month("order_date"),
        "order_week": F.weekofyear("order_date"), "order_year_month": F.date_format("order_date", "yyyy-MM"),
    })


def customers(spark: SparkSession, *rows) -> DataFrame:
    """(user_id, first day, loyal) lines."""
    lines = [(u, date.fromisoformat(d), loyal) for u, d, loyal in rows]
    return spark.createDataFrame(lines, "user_id string, first_order_date date, is_loyalty boolean")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS date_key")
