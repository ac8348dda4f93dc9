"""Exact percentiles of bounded whole numbers, from counts.

Resolution hours are whole numbers of at most one year, so a group holds at most 8,761 distinct
values however many rows it has. Counting rows per (group, value) is a plain hash aggregate that
combines on the map side; percentiles are then read off running counts. The result is exact, needs
no sketch, and a group with a third of all rows costs the same as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BELOW = "__below"
TOTAL = "__total"


def running_counts(counts: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Per row, the weight of the group's non-null values up to this one and in all."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = F.when(F.col(value).isNotNull(), F.col(weight))
    whole = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumns({BELOW: F.sum(counted).over(upto), TOTAL: F.sum(counted).over(whole)})


def percentile(value: str, percent: int) -> Column:
    """Aggregate over ``running_counts``: the least value that ``percent`` % of the rows reach.

    Whole-number arithmetic, so no rounding of p·n can shift the answer by one row.
    """
    reached = F.col(BELOW) * 100 >= F.col(TOTAL) * percent
    return F.min(F.when(reached & F.col(value).isNotNull(), F.col(value)))


def mean(value: str, weight: str) -> Column:
    """Aggregate over counts: mean of the non-null values."""
    present = F.when(F.col(value).isNotNull(), F.col(weight))
    return F.try_divide(
        F.sum(F.col(value) * F.col(weight)).cast("double"), F.sum(present).cast("double")
    )


def total(weight: str, condition: Column | None = None) -> Column:
    """Aggregate over counts: weight of the rows that meet ``condition``; zero, never null."""
    counted = F.col(weight) if condition is None else F.when(condition, F.col(weight))
    return F.coalesce(F.sum(counted), F.lit(0))
