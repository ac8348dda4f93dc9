"""Attributes of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_heat_season(day: Column) -> Column:
    """October 1 to May 31, the statutory heating period."""
    return ~F.month(day).between(6, 9)


def season(day: Column) -> Column:
    """Meteorological season: three whole months each, winter from December."""
    names = F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Autumn")])
    return F.get(names, F.floor((F.month(day) % 12) / 3).cast("int"))


def day_attributes(day: Column) -> list[Column]:
    return [
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        month_label(day).alias("year_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        week_start(day).alias("week_start_date"),
        month_start(day).alias("month_start_date"),
        is_heat_season(day).alias("is_heat_season"),
        season(day).alias("season"),
    ]
