"""Local days, elapsed time and the plausibility rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a reportable resolution is at most one year, in whole hours.
MAX_PLAUSIBLE_HOURS = 8760
UTC_NAMES = {"UTC", "Etc/UTC"}


def local_day(moment: Column, source_tz: str, local_tz: str, session_tz: str | None = None) -> Column:
    """Calendar day in ``local_tz`` of a zoneless timestamp written in ``source_tz``.

    Where the session runs in UTC and so does the source, a zoneless value and its instant coincide,
    and shifting the instant is several times cheaper per row than converting the wall clock.
    """
    if session_tz in UTC_NAMES and source_tz in UTC_NAMES:
        return F.from_utc_timestamp(moment.cast("timestamp"), F.lit(local_tz)).cast("date")
    return F.convert_timezone(F.lit(source_tz), F.lit(local_tz), moment).cast("date")


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole hours between two zoneless timestamps, truncated toward zero; may be negative.

    Taken from the day-time interval rather than ``timestampdiff``, which would read zoneless
    values in the session zone and so lose or gain an hour across a clock change there.
    """
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 24 + F.extract(F.lit("HOUR"), gap).cast("bigint")
    )


def elapsed_days(hours: Column) -> Column:
    return hours / F.lit(24.0)


def is_implausible(start: Column, end: Column, hours: Column) -> Column:
    """Ended before it started (as instants), or ran for more than a year. Never null."""
    return F.coalesce((end < start) | (hours > MAX_PLAUSIBLE_HOURS), F.lit(False))


def reportable_hours(is_closed: Column, implausible: Column, hours: Column) -> Column:
    return F.when(is_closed & ~implausible, hours)


def last_moved(updated: Column, created: Column) -> Column:
    """When a request last changed: its resolution update, or its creation if never updated."""
    return F.coalesce(updated, created)
