"""Units, ratios, weighted means and bucket rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fahrenheit(celsius: Column) -> Column:
    return F.round(celsius * 9 / 5 + 32, 1)


def inches(length: Column, per_inch: float) -> Column:
    return F.round(length / F.lit(per_inch), 2)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when the whole is zero or either is null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def weighted_mean(mean: str, weight: str) -> Column:
    """Mean over groups from their means and sizes. A group without a mean carries no weight."""
    return ratio(F.sum(F.col(mean) * F.col(weight)), F.sum(weight))


def to_bucket(value: Column, width: int) -> Column:
    return F.round(value / width) * width
