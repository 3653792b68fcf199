"""The order fact: one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import hour_bucket, order_date_parts
from ordermill.functions.numbers import percent
from ordermill.schemas import money, stamped


def fact_orders(items: DataFrame, options: DataFrame, run_ts: str | None = None, extras: bool = False) -> DataFrame:
    """Order totals of items and of their options; options without a line item do not count.

    Lines and options are dealt out by order once, as they are; summing per
    line item, where the two meet, and per order then needs no other shuffle.
    Header columns are the smallest non-NULL value should lines of one order differ.
    """
    line = ["ORDER_ID", "LINEITEM_ID"]
    header = ["USER_ID", "RESTAURANT_ID", "order_date", "CREATION_TIME_UTC", "order_hour", *(["APP_NAME"] if extras else [])]
    lines = items.select(*line, *header, "line_item_revenue", "IS_LOYALTY", F.lit(True).alias("is_line"))
    # A key with a NULL equals no line.
    theirs = options.filter(F.col("ORDER_ID").isNotNull() & F.col("LINEITEM_ID").isNotNull()).select(
        *line, "option_revenue", "is_paid_option")
    per_line = (
        lines.unionByName(theirs, allowMissingColumns=True).repartition("ORDER_ID").groupBy(*line).agg(
            F.count("is_line").alias("copies"),
            *[F.min(c).alias(c) for c in header],
            F.sum("line_item_revenue").alias("line_item_revenue"),
            F.bool_or("IS_LOYALTY").alias("IS_LOYALTY"),
            money(F.sum("option_revenue")).alias("option_revenue"),
            F.count_if("is_paid_option").alias("paid_options"),
        ).filter(F.col("copies") > 0)
    )
    # Options count with each copy of their line.
    copies = F.col("copies")
    totals = per_line.groupBy(F.col("ORDER_ID").alias("order_id")).agg(
        F.min("USER_ID").alias("user_id"),
        F.min("RESTAURANT_ID").alias("restaurant_id"),
        F.min("order_date").alias("order_date"),
        F.min("CREATION_TIME_UTC").alias("order_datetime"),
        F.min("order_hour").alias("order_hour"),
        F.coalesce(F.sum(F.when(F.col("LINEITEM_ID").isNotNull(), copies)), F.lit(0)).alias("item_count"),
        money(F.sum("line_item_revenue")).alias("total_item_revenue"),
        money(F.coalesce(F.sum(F.col("option_revenue") * copies.cast("int")), F.lit(0))).alias("total_option_revenue"),
        F.sum(F.col("paid_options") * copies).alias("paid_option_count"),
        F.bool_or("IS_LOYALTY").alias("is_loyalty"),
        *([F.min("APP_NAME").alias("app_name")] if extras else []),
    )
    result = totals.withColumns({
        **order_date_parts(F.col("order_date")),
        "total_revenue": money(F.col("total_item_revenue") + F.col("total_option_revenue")),
        "has_paid_options": F.col("paid_option_count") > 0,
        "is_anonymous": F.col("user_id").isNull(),
        **({"hour_bucket": hour_bucket(F.col("order_hour"))} if extras else {}),
    }).select(
        "order_id", "user_id", "restaurant_id", "order_date", "order_datetime", "order_hour",
        "order_year", "order_month", "order_week", "order_year_month",
        "item_count", "total_item_revenue", "total_option_revenue", "total_revenue",
        "has_paid_options", "paid_option_count", "is_loyalty", "is_anonymous",
        *(["hour_bucket", "app_name"] if extras else []),
    )
    return stamped(result, "gold_ingestion_ts", run_ts)


def fact_profile(fact: DataFrame) -> DataFrame:
    """One row: orders, known customers, revenue and anonymous percent."""
    return fact.agg(
        F.count("*").alias("orders"),
        F.count_distinct("user_id").alias("customers"),
        money(F.coalesce(F.sum("total_revenue"), F.lit(0))).alias("revenue"),
        percent(F.count_if("is_anonymous"), F.count("*")).alias("anonymous_pct"),
    )
