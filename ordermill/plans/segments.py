"""Recency, frequency and monetary scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import rfm_segment, rfm_segment_lifetime
from ordermill.functions.numbers import magnitude_bucket
from ordermill.operators.order_statistics import BITS_IN_ALL, rank_key, tile_cuts, with_tile
from ordermill.schemas import money, stamped
from ordermill.session import materialize

WINDOW_DAYS = 365


def rfm_base(fact: DataFrame, customers: DataFrame, window_days: int | None = WINDOW_DAYS) -> DataFrame:
    """Recency over the lifetime; frequency and spend of the last ``window_days`` days, or lifetime if None.

    Every customer has a row; without orders in the window frequency and spend are 0.
    """
    known = fact.filter(~F.col("is_anonymous"))
    today = known.agg(F.max("order_date")).scalar()
    dated = known.select("user_id", "order_date", "total_revenue", today.alias("today"))
    counts = F.lit(True) if window_days is None else F.col("order_date") >= F.date_sub("today", window_days)
    measures = dated.groupBy("user_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.max("today").alias("today"),
        F.count_if(counts).alias("frequency"),
        F.sum(F.when(counts, F.col("total_revenue"))).alias("monetary"),
    )
    return customers.select("user_id", "is_loyalty").join(measures, "user_id", "left").select(
        "user_id", "is_loyalty", "last_order_date",
        F.datediff("today", "last_order_date").alias("recency_days"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        money(F.coalesce("monetary", F.lit(0))).alias("monetary"),
    )


def _scored(base: DataFrame, label: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Fifths by each measure, 5 is best; equal values are ordered by id.

    The measures are put below each other, so that one search finds the boundaries of all three.
    """
    scored = materialize(base, "rfm-base")
    keys = {
        "r_score": rank_key(F.col("recency_days"), descending=True),
        "f_score": rank_key(F.col("frequency")),
        "m_score": rank_key(F.col("monetary"), 2),
    }
    lines = F.array(*[F.struct(F.lit(name).alias("score"), key.alias("key")) for name, key in keys.items()])
    long = scored.select("user_id", F.explode(lines).alias("line")).select("user_id", "line.*")
    cuts = tile_cuts(
        long, 5, F.col("key"), "user_id", ["score"], bucket=magnitude_bucket(F.col("key"), BITS_IN_ALL))
    for name, key in keys.items():
        scored = with_tile(scored, name, 5, key, "user_id", cuts=cuts.filter(F.col("score") == name))
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return scored.withColumns({"rfm_score": F.concat(*[s.cast("string") for s in scores]), "segment": label(*scores)})


def rfm_segments(
    fact: DataFrame, customers: DataFrame, window_days: int = WINDOW_DAYS, run_ts: str | None = None,
) -> DataFrame:
    scored = _scored(rfm_base(fact, customers, window_days), rfm_segment)
    return stamped(scored.drop("last_order_date"), "gold_ingestion_ts", run_ts)


def rfm_lifetime(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Variant: all measures over the lifetime, with the segments Promising and Lost."""
    return _scored(rfm_base(fact, customers, None), rfm_segment_lifetime).select(
        "user_id", "last_order_date", "recency_days", "frequency", "monetary",
        "r_score", "f_score", "m_score", F.col("segment").alias("rfm_segment"))
