"""Sales per day, week and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import iso_year
from ordermill.functions.numbers import ratio
from ordermill.operators.distinct_counts import with_distinct_counts
from ordermill.schemas import money, stamped
from ordermill.session import materialize


def loyal(column: str) -> Column:
    """Rows whose flag is true; an unknown flag does not count."""
    return F.count_if(F.coalesce(F.col(column), F.lit(False)))


def sales_daily(items: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Item revenue per day, location and category; an order counts in each of its categories.

    The line items are read once, and summed per order and category before anything is counted.
    """
    keys = ["order_date", "restaurant_id", "item_category"]
    orders = materialize(items.groupBy(
        "order_date", F.col("RESTAURANT_ID").alias("restaurant_id"), F.col("ITEM_CATEGORY").alias("item_category"),
        "ORDER_ID", "USER_ID",
    ).agg(F.sum("line_item_revenue").alias("revenue"), loyal("IS_LOYALTY").alias("loyal_lines")), "orders-by-category")
    result = with_distinct_counts(
        orders, keys,
        [money(F.sum("revenue")).alias("total_item_revenue"), F.sum("loyal_lines").alias("loyalty_line_items")],
        {"order_count": "ORDER_ID", "unique_customers": "USER_ID"},
    ).select(*keys, "order_count", "unique_customers", "total_item_revenue", "loyalty_line_items").withColumns({
        "avg_order_revenue": ratio(F.col("total_item_revenue"), F.col("order_count")),
        "snapshot_year": F.year("order_date"),
    })
    return stamped(result, "gold_ingestion_ts", run_ts)


def _order_measures(*more: Column) -> list[Column]:
    """Measures on the order fact, which has one row per order: orders are rows."""
    return [
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_id").alias("unique_customers"),
        money(F.sum("total_revenue")).alias("total_revenue"),
        ratio(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_order_value"),
        loyal("is_loyalty").alias("loyalty_orders"),
        *more,
    ]


def sales_weekly(fact: DataFrame, run_ts: str | None = None, by_iso_year: bool = False) -> DataFrame:
    """Sales per year, ISO week and location.

    The year is the calendar year, so early January can share a week number
    with late December; ``by_iso_year`` uses the year the week belongs to.
    """
    if by_iso_year:
        fact = fact.withColumn("order_year", iso_year(F.col("order_date")))
    result = fact.groupBy("order_year", "order_week", "restaurant_id").agg(*_order_measures())
    return stamped(result, "gold_ingestion_ts", run_ts)


def sales_monthly(fact: DataFrame, run_ts: str | None = None) -> DataFrame:
    options = money(F.sum("total_option_revenue")).alias("total_option_revenue")
    keys = ["order_year", "order_month", "order_year_month", "restaurant_id"]
    return stamped(fact.groupBy(*keys).agg(*_order_measures(options)), "gold_ingestion_ts", run_ts)
