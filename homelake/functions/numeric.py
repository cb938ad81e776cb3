"""Casts, tolerant indexing and arithmetic with the null rules the tables need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, type_name: str) -> Column:
    """Cast to a whole-number type, rounding ties to even (a plain cast would cut the fraction off)."""
    return F.rint(value.cast("double")).cast(type_name)


def nth(items: Column, position: int) -> Column:
    """1-based array element; null when the array is too short."""
    return F.get(items, F.lit(position - 1))


def midpoint(low: Column, high: Column) -> Column:
    return (low + high) / F.lit(2)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio that is null for a zero or missing divisor."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def round_to_grid(value: Column, digits: int) -> Column:
    """Snap to a decimal grid by scaling first, so that grid cells do not depend on the shortest decimal text."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale
