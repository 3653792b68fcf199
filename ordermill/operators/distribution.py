"""Counts, shares and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.numbers import percent
from ordermill.session import materialize


def count_and_share(df: DataFrame, keys: Sequence[str], count_name: str = "row_count", digits: int = 2) -> DataFrame:
    """Rows per key and their percent of all rows.

    The input is read once: the total is the sum of the stored counts.
    """
    counts = materialize(df.groupBy(*keys).agg(F.count("*").alias(count_name)), "counts")
    total = counts.agg(F.coalesce(F.sum(count_name), F.lit(0))).scalar()
    return counts.withColumn("pct", percent(F.col(count_name), total, digits))


def hash_sample(df: DataFrame, row_id: str, size: int, seed: int = 42) -> DataFrame:
    """Up to ``size`` rows in the order of md5("seed:id"), the same on every run, partitioning and engine."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), row_id).limit(size)


def range_label(value: Column, bounds: Sequence[tuple[int, int | None, str]]) -> Column:
    """Label of the first (low, high, label) range that holds ``value``; ``high`` None is open."""
    chain = F
    for low, high, label in bounds:
        inside = value >= low if high is None else value.between(low, high)
        chain = chain.when(inside, F.lit(label))
    return chain
