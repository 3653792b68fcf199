"""Anonymous, loyalty and other customers compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import loyalty_segment
from ordermill.functions.numbers import percent, ratio
from ordermill.schemas import money, stamped


def loyalty_comparison(fact: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per segment; loyalty belongs to the order, so a customer may be in two segments.

    Orders are summed per customer first and customers per segment then.  Both
    steps combine before their shuffle, and neither needs a distinct count.
    """
    segment = loyalty_segment(F.col("is_anonymous"), F.col("is_loyalty"))
    per_customer = fact.groupBy(segment.alias("segment"), "user_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("total_revenue").alias("revenue"),
        F.count_if("has_paid_options").alias("paid"),
    )
    known = F.col("user_id").isNotNull()
    customers = F.count("user_id")
    result = per_customer.groupBy("segment").agg(
        customers.alias("customer_count"),
        F.sum("orders").alias("order_count"),
        money(F.sum("revenue")).alias("total_revenue"),
        ratio(F.sum("revenue"), F.sum("orders")).alias("avg_spend_per_order"),
        ratio(F.sum(F.when(known, F.col("orders"))), customers).alias("avg_orders_per_customer"),
        ratio(F.sum(F.when(known, F.col("revenue"))), customers).alias("avg_customer_spend"),
        percent(F.count_if(known & (F.col("orders") >= 2)), customers).alias("repeat_customer_rate_pct"),
        percent(F.sum("paid"), F.sum("orders")).alias("option_attach_rate_pct"),
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


def loyalty_lifetime_value(fact: DataFrame) -> DataFrame:
    """Variant: known customers by whether they were ever loyal, with mean lifetime value."""
    per_customer = fact.filter(~F.col("is_anonymous")).groupBy("user_id").agg(
        F.bool_or("is_loyalty").alias("is_loyalty"),
        F.count("order_id").alias("orders"),
        F.sum("total_revenue").alias("revenue"),
    )
    orders, revenue, customers = F.sum("orders"), F.sum("revenue"), F.count("*")
    return per_customer.groupBy("is_loyalty").agg(
        customers.alias("customer_count"),
        orders.alias("total_orders"),
        money(revenue).alias("total_revenue"),
        ratio(revenue, customers).alias("avg_clv"),
        ratio(revenue, orders).alias("avg_order_value"),
        percent(F.count_if(F.col("orders") > 1), customers, 2).alias("repeat_order_rate"),
        ratio(orders, customers).alias("avg_orders_per_customer"),
    )
