"""Churn indicators for customers with at least two orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import churn_tag
from ordermill.functions.numbers import money_percent, ratio
from ordermill.schemas import money, stamped

# Day limits, multiples of the own gap, and the limits of the variant.
DAY_LIMITS = (30, 45, 60)
GAP_FACTORS = (1.5, 2.0, 3.0)
VARIANT_DAY_LIMITS = (30, 45, 90)


def churn_indicators(fact: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Spend trend, order gap and two churn tags.

    The last order is the greatest by (day, time, id).  It is picked by an
    aggregate, and the mean of the earlier orders follows from the sums: no
    window, so a customer with very many orders is no heavier than others.
    """
    known = fact.filter(~F.col("is_anonymous"))
    today = known.agg(F.max("order_date")).scalar()
    latest = F.max_by("total_revenue", F.struct("order_date", "order_datetime", "order_id"))
    per_customer = known.groupBy("user_id").agg(
        F.count("*").alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        money(latest).alias("recent_spend"),
        money(F.sum("total_revenue")).alias("spend"),
    ).filter(F.col("total_orders") >= 2)
    orders = F.col("total_orders")
    measured = per_customer.withColumns({
        "prior_avg_spend": ratio(F.col("spend") - F.col("recent_spend"), orders - 1),
        "avg_gap_days": ratio(F.datediff("last_order_date", "first_order_date"), orders - 1, 1),
        "days_since_last_order": F.datediff(today, F.col("last_order_date")),
    })
    days, prior = F.col("days_since_last_order"), F.col("prior_avg_spend")
    gap = F.when(F.col("avg_gap_days") <= 0, 1).otherwise(F.col("avg_gap_days")).cast("decimal(18,2)")
    result = measured.select(
        "user_id", "total_orders", "first_order_date", "last_order_date", "recent_spend", "prior_avg_spend",
        "avg_gap_days", "days_since_last_order",
        churn_tag(days, DAY_LIMITS).alias("churn_tag"),
        churn_tag(days, [gap * F.lit(f).cast("decimal(3,1)") for f in GAP_FACTORS]).alias("churn_tag_personal"),
        F.when(prior > 0, money_percent(F.col("recent_spend") - prior, prior)).alias("spend_change_pct"),
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


def churn_recent_spend(fact: DataFrame, span: int = 90) -> DataFrame:
    """Variant for all customers: spend of the last ``span`` days against the ``span`` days before."""
    known = fact.filter(~F.col("is_anonymous"))
    today = known.agg(F.max("order_date")).scalar()
    aged = known.select("user_id", "order_date", "total_revenue", F.datediff(today, F.col("order_date")).alias("age"))
    age = F.col("age")
    zero = F.lit(0)
    per_customer = aged.groupBy("user_id").agg(
        F.count("*").alias("total_orders"),
        F.min("age").alias("days_since_last_order"),
        F.max("age").alias("oldest"),
        money(F.sum(F.when(age < span, F.col("total_revenue")).otherwise(zero))).alias("recent_spend"),
        money(F.sum(F.when((age >= span) & (age < 2 * span), F.col("total_revenue")).otherwise(zero)))
        .alias("prior_spend"),
    )
    return per_customer.select(
        "user_id", "total_orders", "days_since_last_order",
        ratio(F.col("oldest") - F.col("days_since_last_order"), F.col("total_orders") - 1)
        .alias("avg_days_between_orders"),
        money_percent(F.col("recent_spend") - F.col("prior_spend"), F.col("prior_spend"), 2).alias("spend_trend_pct"),
        churn_tag(F.col("days_since_last_order"), VARIANT_DAY_LIMITS).alias("churn_tag"),
    )
