"""Labels for tiers, segments and churn tags, and their display order.

Fixed values throughout: the label texts, the score limits and the day limits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CHURN_ORDER = ("Active", "Cooling Off", "At Risk", "Inactive")
SEGMENT_ORDER = ("Loyalty", "Non-Loyalty", "Anonymous")
SPEND_TIERS = ("High", "Medium", "Low")


def spend_tier(tile: Column, tiles: int = 5) -> Column:
    """Top tile High, bottom tile Low, the rest Medium."""
    return F.when(tile == tiles, "High").when(tile == 1, "Low").otherwise("Medium")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when(F.least(r, f, m) >= 4, "VIP")
        .when((f >= 4) & (m >= 3), "Loyal")
        .when(m >= 4, "Big Spender")
        .when((r >= 4) & (f <= 2), "New Customer")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when(F.greatest(r, f, m) <= 2, "Churn Risk")
        .otherwise("Regular")
    )


def rfm_segment_lifetime(r: Column, f: Column, m: Column) -> Column:
    """Segments of the lifetime variant, with Promising and Lost."""
    return (
        F.when(F.least(r, f, m) >= 4, "VIP")
        .when((f >= 4) & (m >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New Customer")
        .when((r >= 3) & (f >= 2) & (m >= 2), "Promising")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when(F.greatest(r, f, m) <= 2, "Lost")
        .otherwise("Regular")
    )


def churn_tag(days: Column, limits: Sequence[Column | int]) -> Column:
    """First of Active, Cooling Off and At Risk whose limit is not exceeded, else Inactive."""
    active, cooling, risk = limits
    return (
        F.when(days <= active, CHURN_ORDER[0]).when(days <= cooling, CHURN_ORDER[1])
        .when(days <= risk, CHURN_ORDER[2]).otherwise(CHURN_ORDER[3])
    )


def loyalty_segment(is_anonymous: Column, is_loyalty: Column) -> Column:
    loyalty, other, anonymous = SEGMENT_ORDER
    return F.when(is_anonymous, anonymous).when(is_loyalty, loyalty).otherwise(other)


def loyalty_label(is_loyalty: Column) -> Column:
    return F.when(is_loyalty, "Loyalty").when(~is_loyalty, "Non-Loyalty").otherwise("Unknown")


def position_in(col: Column, order: Sequence[str]) -> Column:
    """0-based place of a label in its display order, for sorting."""
    return F.array_position(F.array(*map(F.lit, order)), col) - 1
