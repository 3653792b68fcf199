"""Counts that tell at a glance whether a built table looks right."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(table: str, df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row per measure: all rows of the table, and those a condition holds for; the table is read once."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(holds).alias(name) for name, holds in measures.items()])
    lines = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).alias("row_count")) for name in ("rows", *measures)])
    return counts.select(F.lit(table).alias("table_name"), F.explode(lines).alias("line")).select("table_name", "line.*")


def result_profiles(customers: DataFrame, days: DataFrame, segments: DataFrame) -> DataFrame:
    """Tiers and loyalty of customers, week-ends and holidays of the calendar, customers with orders in the RFM window."""
    tier = F.col("clv_tier")
    tiers = {f"{name.lower()} tier": F.coalesce(tier == name, F.lit(False)) for name in ("High", "Medium", "Low")}
    return profile("dim_customer", customers, {**tiers, "loyalty": F.col("is_loyalty")}).unionByName(
        profile("dim_date", days, {"week-ends": F.col("is_weekend"), "holidays": F.col("is_holiday")})).unionByName(
        profile("gold_rfm_segments", segments, {"in window": F.col("frequency") > 0}))
