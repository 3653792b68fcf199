"""Keeping one row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest in the order of the other columns, NULLs first.

    A plain aggregate, so copies of one key collapse before the shuffle and no
    task ever holds all copies of a hot key.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return chosen.select(*[F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns])


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows there are, how many keys, and how many rows a dedupe removes."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count("*").alias("key_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_count"),
    )
