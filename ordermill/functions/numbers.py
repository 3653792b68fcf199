"""Exact ratios and order-preserving integer keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half up, NULL where the denominator is 0.

    Both sides are decimals, so that the quotient carries 20 digits after the
    point and the rounding is that of the exact value.
    """
    quotient = F.try_divide(numerator.cast("decimal(20,2)"), denominator.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast("decimal(18,2)")


def money_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Like ``ratio`` with a denominator that is an amount with cents."""
    return ratio(numerator * 100, F.round(denominator.cast("decimal(18,2)") * 100), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part * 100, whole, digits)


def money_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return money_ratio(part.cast("decimal(18,2)") * 100, whole, digits)


def integer_key(col: Column, scale: int = 0) -> Column:
    """A number with up to ``scale`` decimals as a bigint of the same order."""
    if scale == 0:
        return col.cast("bigint")
    return F.round(col.cast(f"decimal(20,{scale})") * 10**scale).cast("bigint")


def magnitude_bucket(key: Column, bits: int = 5) -> Column:
    """Coarse, monotone bucket of a bigint: its bit length and its ``bits`` bits after the first.

    There are at most ``64 * 2**bits`` buckets for each sign whatever the data,
    and a bucket spans at most ``2**-bits`` of its values' size.
    """
    def positive(x: Column) -> Column:
        length = F.length(F.bin(x))
        drop = F.greatest(length - (bits + 1), F.lit(0))
        mantissa = F.call_function("shiftright", x, drop.cast("int")).bitwiseAND(F.lit((1 << bits) - 1))
        return (length * (1 << bits) + mantissa).cast("int")

    return F.when(key < 0, -positive(-key)).otherwise(positive(key))
