"""Carrying running totals forward over a gapless calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_intervals(
    daily: DataFrame, entity: str, day: str, totals: dict[str, str], last_day: Column,
) -> DataFrame:
    """Running totals per entity, each with the span of days it stays valid.

    ``daily`` has one row per entity and day, so a window partition is never
    longer than the calendar.  ``totals`` maps new column to summed column;
    ``until`` is the day before the entity's next row, or ``last_day``.
    """
    ordered = Window.partitionBy(entity).orderBy(day)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.date_sub(F.lead(day).over(ordered), 1)
    return daily.withColumns({
        **{new: F.sum(old).over(so_far) for new, old in totals.items()},
        "until": F.coalesce(following, last_day),
    })


def expand_days(intervals: DataFrame, day: str, as_column: str) -> DataFrame:
    """One row per day of each interval; a map-side step, nothing is shuffled."""
    days = F.sequence(F.col(day), F.col("until"))
    return intervals.filter(F.col("until") >= F.col(day)).withColumn(as_column, F.explode(days))


def first_day_only(columns: Sequence[str], day: str, as_column: str) -> dict[str, Column]:
    """Daily measures count on the first day of an interval and are zero on the days carried forward."""
    starts = F.col(as_column) == F.col(day)
    return {c: F.when(starts, F.col(c)).otherwise(0) for c in columns}
