"""Tiles and values by rank for every day of a calendar, from intervals that hold for several days.

An interval (first day, last day, key) stands for one row on each of its days.  The rows are never written out to be
counted: an interval adds one to its bucket on its first day and takes one away after its last, and the running sum of
these changes is the histogram of every day.  Its size is days times buckets, whatever the number of intervals.  For
the wanted ranks it names the buckets to look into, mostly the same ones for long runs of days; only intervals of
these buckets are written out, for the days of these runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.operators.order_statistics import (
    cuts_among, histogram_totals, tile_starts, values_among, wanted_ranks,
)
from ordermill.session import materialize


@dataclass(frozen=True)
class Intervals:
    """Stored intervals and the names of their columns; ``bucket`` is ``magnitude_bucket`` of the bigint ``key``.

    An interval that ends before it begins stands for nothing.
    """

    rows: DataFrame
    first: str
    until: str
    key: str
    bucket: str
    row_id: str


def day_histogram(intervals: Intervals, day: str) -> DataFrame:
    """(day, ``_bucket``, ``_count``): rows per day and bucket, where there are any."""
    one = F.lit(1).cast("bigint")
    changes = F.array(
        F.struct(F.col(intervals.first).alias("_from"), one.alias("_change")),
        F.struct(F.date_add(intervals.until, 1).alias("_from"), (-one).alias("_change")))
    per_day = intervals.rows.filter(F.col(intervals.until) >= F.col(intervals.first)).select(
        F.col(intervals.bucket).alias("_bucket"), F.inline(changes)).groupBy("_bucket", "_from").agg(
        F.sum("_change").alias("_change")).filter("_change <> 0")
    # A bucket has a line per day of the calendar at most.
    in_bucket = Window.partitionBy("_bucket").orderBy("_from")
    running = per_day.withColumns({
        "_count": F.sum("_change").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.lead("_from").over(in_bucket)})
    # All intervals end, so the count after the last change is zero.
    held = running.filter("_count > 0").select(
        "_bucket", "_count", F.explode(F.sequence("_from", F.date_sub("_next", 1))).alias(day))
    return held.select(day, "_bucket", "_count")


def _runs(wanted: DataFrame, day: str) -> DataFrame:
    """Wanted buckets with runs of consecutive days (``_from`` to ``_to``)."""
    cells = wanted.select("_bucket", day).distinct()
    island = F.date_sub(day, F.row_number().over(Window.partitionBy("_bucket").orderBy(day)))
    return cells.withColumn("_island", island).groupBy("_bucket", "_island").agg(
        F.min(day).alias("_from"), F.max(day).alias("_to")).drop("_island")


def _looked_into(intervals: Intervals, wanted: DataFrame, day: str, *columns: Column) -> DataFrame:
    """(day, ``_bucket``, columns): the rows of the wanted buckets on the days they are wanted on."""
    runs = materialize(_runs(wanted, day), "wanted-runs")
    meets = (
        (F.col(intervals.bucket) == F.col("_bucket"))
        & (F.col(intervals.first) <= F.col("_to")) & (F.col(intervals.until) >= F.col("_from")))
    days = F.sequence(F.greatest(intervals.first, "_from"), F.least(intervals.until, "_to"))
    named = intervals.rows.filter(F.col(intervals.until) >= F.col(intervals.first)).join(runs, meets)
    return named.select("_bucket", *columns, F.explode(days).alias(day))


def interval_tile_cuts(intervals: Intervals, tiles: int, day: str) -> DataFrame:
    """``order_statistics.tile_cuts`` of every day."""
    totals = histogram_totals(day_histogram(intervals, day), [day])
    wanted = materialize(wanted_ranks(totals, [day], tile_starts(tiles)), "tile-ranks")
    rows = _looked_into(intervals, wanted, day, F.col(intervals.key).alias("_key"), F.col(intervals.row_id).alias("_id"))
    return cuts_among(rows, wanted, [day], tiles)


def interval_values_at(
    intervals: Intervals, day: str, ranks: dict[str, Column], counted: dict[str, Column] | None = None,
) -> DataFrame:
    """Values at 0-based ranks of the ascending keys of every day: the day, ``_n``, ``counted``, and one bigint per name.

    ``ranks`` maps names to expressions of ``_n``, the number of rows of the day, and of the names of ``counted``;
    these are numbers of rows whose bucket meets a condition on ``_bucket``.  A rank outside the day gives no value.
    """
    counted = counted or {}
    totals = materialize(histogram_totals(day_histogram(intervals, day), [day]), "day-totals")
    named = F.array(*[F.struct(F.lit(n).alias("name"), r.cast("bigint").alias("rank")) for n, r in ranks.items()])
    # Ranks are worked out once a day, not once a bucket.
    heads = totals.groupBy(day).agg(F.max("_n").alias("_n"), *[
        F.sum(F.when(condition, F.col("_count")).otherwise(0)).alias(name) for name, condition in counted.items()])
    heads = materialize(heads.withColumn("_ranks", named), "day-ranks")
    wanted = materialize(wanted_ranks(totals.join(heads.select(day, "_ranks"), day), [day], F.col("_ranks")), "value-ranks")
    rows = _looked_into(intervals, wanted, day, F.col(intervals.key).alias("_key"))
    values = values_among(rows, wanted, [day], list(ranks))
    return values.join(heads.select(day, *counted), day) if counted else values
