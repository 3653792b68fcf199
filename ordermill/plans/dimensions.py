"""Dimensions: calendar, customers, locations and menu items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.dates import calendar_extras, calendar_parts
from ordermill.functions.labels import spend_tier
from ordermill.functions.numbers import ratio
from ordermill.operators.order_statistics import rank_key, with_tile
from ordermill.schemas import money, stamped
from ordermill.operators.distinct_counts import with_distinct_counts
from ordermill.session import materialize

TIERS = 5


def dim_date(items: DataFrame, holidays: DataFrame, run_ts: str | None = None, extras: bool = False) -> DataFrame:
    """Every day from the first to the last order day, with calendar attributes and holidays."""
    span = items.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    day = F.col("date_key")
    parts = {**calendar_parts(day), **(calendar_extras(day) if extras else {})}
    calendar = (
        days.withColumns(parts)
        .join(holidays.select("date_key", "holiday_name"), "date_key", "left")
        .withColumn("is_holiday", F.col("holiday_name").isNotNull())
        .orderBy("date_key")
    )
    return stamped(calendar, "gold_ingestion_ts", run_ts)


def dim_customer(items: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Known customers with lifetime totals, most visited location and spend tier.

    The most visited location is the one with most line items, the smaller id
    on a tie; tiers are fifths by spend on items, equal spend ordered by id.
    """
    known = items.filter(F.col("USER_ID").isNotNull())
    totals = (
        known.groupBy("USER_ID").agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count_distinct("ORDER_ID").alias("total_orders"),
            money(F.sum("line_item_revenue")).alias("total_spend"),
            F.bool_or("IS_LOYALTY").alias("is_loyalty"),
        )
        .withColumns({
            "tenure_days": F.datediff("last_order_date", "first_order_date"),
            "avg_order_value": ratio(F.col("total_spend"), F.col("total_orders")),
        })
    )
    visits = known.groupBy("USER_ID", "RESTAURANT_ID").agg(F.count("*").alias("visits"))
    favourite = (
        visits.groupBy("USER_ID")
        .agg(F.min(F.struct(-F.col("visits"), F.col("RESTAURANT_ID").alias("id"))).alias("top"))
        .select("USER_ID", F.col("top.id").alias("primary_restaurant_id"))
    )
    customers = materialize(
        totals.join(favourite, "USER_ID", "left").withColumnRenamed("USER_ID", "user_id"), "customers")
    tiered = with_tile(customers, "tile", TIERS, rank_key(F.col("total_spend"), 2), "user_id")
    result = tiered.withColumn("clv_tier", spend_tier(F.col("tile"), TIERS)).select(
        "user_id", "first_order_date", "last_order_date", "tenure_days", "total_orders", "total_spend",
        "avg_order_value", "is_loyalty", "primary_restaurant_id", "clv_tier",
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


def dim_restaurant(items: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Locations with totals on item revenue and a revenue rank, the smaller id first on a tie.

    The line items are read once, and summed per order before anything is counted.
    """
    orders = materialize(items.groupBy(
        F.col("RESTAURANT_ID").alias("restaurant_id"), "ORDER_ID", "USER_ID", "order_date",
    ).agg(F.sum("line_item_revenue").alias("revenue")), "orders-by-location")
    totals = with_distinct_counts(
        orders, ["restaurant_id"],
        [money(F.sum("revenue")).alias("total_revenue"), F.min("order_date").alias("first_order_date"),
         F.max("order_date").alias("last_order_date")],
        {"total_orders": "ORDER_ID", "unique_customers": "USER_ID", "active_days": "order_date"})
    # One line per location: the only rows a single ordered window ever sees.
    by_revenue = Window.orderBy(F.desc("total_revenue"), "restaurant_id")
    result = totals.withColumns({
        "avg_order_value": ratio(F.col("total_revenue"), F.col("total_orders")),
        "revenue_rank": F.row_number().over(by_revenue),
    }).select(
        "restaurant_id", "total_orders", "total_revenue", "unique_customers", "avg_order_value",
        "first_order_date", "last_order_date", "active_days", "revenue_rank",
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


def dim_menu_item(items: DataFrame, run_ts: str | None = None, with_key: bool = False) -> DataFrame:
    """Named menu items per category with volumes and prices; ``with_key`` adds a hash key."""
    sold = items.filter(F.col("ITEM_NAME").isNotNull())
    result = sold.groupBy(
        F.col("ITEM_NAME").alias("item_name"), F.col("ITEM_CATEGORY").alias("item_category"),
    ).agg(
        F.count_distinct("ORDER_ID").alias("total_orders_sold"),
        F.sum("ITEM_QUANTITY").alias("total_quantity_sold"),
        money(F.sum("line_item_revenue")).alias("total_revenue"),
        ratio(F.sum("ITEM_PRICE"), F.count("ITEM_PRICE")).alias("avg_price"),
        F.min("ITEM_PRICE").alias("min_price"),
        F.max("ITEM_PRICE").alias("max_price"),
        F.min("order_date").alias("first_sold_date"),
        F.max("order_date").alias("last_sold_date"),
    )
    if with_key:
        key = F.sha2(F.concat_ws("\x1f", "item_name", "item_category"), 256)
        result = result.select(key.alias("item_key"), *result.columns)
    return stamped(result, "gold_ingestion_ts", run_ts)
