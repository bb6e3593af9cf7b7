"""Numeric column expressions shared by the scored operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT = "decimal(38,10)"


def round_half_up(value: Column, digits: int | None) -> Column:
    """Round half up in decimal arithmetic, so that every engine agrees.

    Ten decimal digits absorb the order-dependent noise of double sums before
    the visible rounding happens. What no such decimal can hold (from 1e28 on, NaN)
    has no digits to round and stays as it is.
    """
    if digits is None:
        return value.cast("double")
    rounded = F.round(value.try_cast(EXACT), digits).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit a value to a range; NULL stays NULL."""
    return F.when(value > high, F.lit(high)).when(value < low, F.lit(low)).otherwise(value)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """Share of ``part`` in ``whole`` in percent; NULL for an empty whole."""
    return round_half_up(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)


def pearson(dot: Column, left_squares: Column, right_squares: Column) -> Column:
    """Correlation from its three sums; NULL where either side has no variance."""
    norm = F.sqrt(left_squares * right_squares)
    return F.when(norm != 0, dot / norm)
