"""Variant of the lifetime value snapshot: tiers by percent rank and a 90-day activity flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.interval_statistics import interval_values_at
from ordermill.plans.lifetime_value import SpendIntervals, stored_intervals
from ordermill.session import materialize

ACTIVE_DAYS = 90


def clv_by_percent_rank(
    fact: DataFrame, customers: DataFrame, calendar: DataFrame, intervals: SpendIntervals | None = None, keyed: bool = False,
) -> DataFrame:
    """One row per customer and day; equal running spend always shares a tier.

    High from percent rank 0.8 on, Low below 0.2.  Percent rank is the number
    of customers with less spend over (customers - 1), so "at least h customers
    have less" means "more than the h-th smallest spend": two values per day
    decide all tiers.  ``keyed`` adds ``spend_key``, the spend in cents (``rank_key``).
    """
    intervals = intervals or stored_intervals(fact, customers, calendar)
    # Whole-number ceilings of 0.8 and 0.2 of the other customers.
    ranks = {"high_above": F.expr("(4 * (_n - 1) + 4) div 5 - 1"), "low_up_to": F.expr("((_n - 1) + 4) div 5 - 1")}
    limits = materialize(interval_values_at(intervals.by_spend, "date_key", ranks), "spend-limits")
    dense = intervals.expanded().join(limits, "date_key", "left").withColumnRenamed("date_key", "snapshot_date")
    # The stored sort key: it need not be made from the decimal again on each customer-day.
    spend = F.col("spend_key")
    tier = (
        F.when(spend > F.col("high_above"), "High")
        .when(spend > F.col("low_up_to"), "Medium")
        .otherwise("Low")
    )
    return dense.select(
        "user_id", "snapshot_date", "cumulative_orders", "cumulative_spend", tier.alias("clv_tier"),
        F.datediff("snapshot_date", "first_order_date").alias("days_as_customer"),
        (F.datediff("snapshot_date", "day") <= ACTIVE_DAYS).alias("is_active"), *(["spend_key"] if keyed else []),
    )
