"""Calendar attributes of dates and hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_date_parts(day: Column) -> dict[str, Column]:
    """Calendar year, month and ISO week of an order day; early January may fall into week 52 or 53."""
    return {
        "order_year": F.year(day),
        "order_month": F.month(day),
        "order_week": F.weekofyear(day),
        "order_year_month": F.date_format(day, "yyyy-MM"),
    }


def calendar_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "week": F.weekofyear(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def calendar_extras(day: Column) -> dict[str, Column]:
    """Month name, quarter and the day number that starts on Monday."""
    return {
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "day_of_week_num": F.weekday(day) + 1,
    }


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def hour_bucket(hour: Column) -> Column:
    return (
        F.when(hour <= 5, "Night").when(hour <= 11, "Morning")
        .when(hour <= 17, "Afternoon").when(hour <= 23, "Evening")
    )
