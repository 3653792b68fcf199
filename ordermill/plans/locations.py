"""Performance of locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numbers import percent, ratio
from ordermill.plans.sales import loyal
from ordermill.schemas import money, stamped


RANKS = {"revenue_rank": "total_revenue", "orders_rank": "total_orders", "customers_rank": "unique_customers"}


def location_perf(fact: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Volume, retention and ranks per location."""
    return stamped(with_ranks(location_measures(fact)), "gold_ingestion_ts", run_ts)


def with_ranks(locations: DataFrame) -> DataFrame:
    """Ranks over one line per location."""
    return locations.select("*", *[
        F.row_number().over(Window.orderBy(F.desc(measure), "restaurant_id")).alias(name) for name, measure in RANKS.items()])


def location_measures(fact: DataFrame) -> DataFrame:
    """Volume and retention per location.

    Orders are summed per location and customer, then per location; a location
    with a third of all orders spreads over its customers.  Retention is the
    percent of known customers with two or more orders at the location.
    """
    per_visitor = fact.groupBy("restaurant_id", "user_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("total_revenue").alias("revenue"),
        loyal("is_loyalty").alias("loyalty_orders"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
    )
    repeats = F.count_if(F.col("user_id").isNotNull() & (F.col("orders") >= 2))
    totals = per_visitor.groupBy("restaurant_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("user_id").alias("unique_customers"),
        money(F.sum("revenue")).alias("total_revenue"),
        F.sum("loyalty_orders").alias("loyalty_orders"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        # No known customer, no retention figures.
        F.when(F.count("user_id") > 0, repeats).alias("repeat_customer_count"),
        percent(repeats, F.count("user_id")).alias("retention_rate_pct"),
    )
    weeks = fact.groupBy("restaurant_id").agg(F.count_distinct("order_year", "order_week").alias("active_weeks"))
    active = F.col("active_weeks")
    return totals.join(weeks, F.equal_null(totals["restaurant_id"], weeks["restaurant_id"])).drop(
        weeks["restaurant_id"]).select(
        "restaurant_id", "total_orders", "unique_customers", "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
        "active_weeks", "first_order_date", "last_order_date",
        ratio(F.col("total_orders"), active, 1).alias("orders_per_week"),
        ratio(F.col("total_revenue"), active).alias("revenue_per_week"),
        percent(F.col("loyalty_orders"), F.col("total_orders")).alias("loyalty_order_pct"),
        "repeat_customer_count", "retention_rate_pct",
    )
