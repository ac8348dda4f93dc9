"""Run settings.

Every function that depends on "now" takes it from ``Settings.as_of``; only the job runner may
default it to the clock. That keeps plans deterministic, testable and replayable.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_WORDS = {"1", "true", "yes"}
ALL_SOURCES = ("requests", "weather")


def utc_now() -> datetime:
    """Current instant as a naive UTC datetime, the form used throughout."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def shift_months(day: date, months: int) -> date:
    """Calendar-month arithmetic clipped to the last day of the month, like SQL's add_months."""
    years, month0 = divmod(day.year * 12 + day.month - 1 + months, 12)
    first_of_next = date(years + (month0 == 11), (month0 + 1) % 12 + 1, 1)
    return date(years, month0 + 1, min(day.day, (first_of_next - timedelta(days=1)).day))


@dataclass(frozen=True)
class Settings:
    as_of: datetime = field(default_factory=utc_now)
    # The analytical window of the lifecycle fact.
    analysis_window_months: int = 24
    # How far behind the last movement an incremental run re-reads.
    incremental_lookback_days: int = 30
    # How long a closed request stays in the status history's scope.
    snapshot_window_days: int = 45
    # First-run reach of the two landing cursors, and the trailing re-read of observations.
    backfill_months: int = 24
    update_lookback_days: int = 30
    weather_lookback_days: int = 14
    # Landed chunks taken per run; 0 means no cap.
    max_chunks_per_run: int = 0
    spine_start: date = date(2023, 1, 1)
    # Zone in which the feed's zoneless timestamps are written, and the zone of the reports.
    source_tz: str = "UTC"
    local_tz: str = "America/New_York"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Settings:
        """Integer settings from ``DESKWISE_*`` variables; a value that is not a number raises."""
        env = os.environ if env is None else env
        names = (
            "analysis_window_months",
            "incremental_lookback_days",
            "snapshot_window_days",
            "backfill_months",
            "update_lookback_days",
            "weather_lookback_days",
            "max_chunks_per_run",
        )
        read = {n: int(env[f"DESKWISE_{n.upper()}"]) for n in names if f"DESKWISE_{n.upper()}" in env}
        return cls(**{**read, **overrides})

    @property
    def today(self) -> date:
        """UTC calendar day of ``as_of``."""
        return self.as_of.date()

    @property
    def local_today(self) -> date:
        return self.as_of.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(self.local_tz)).date()

    @property
    def spine_end(self) -> date:
        """Exclusive end of the calendar: one year ahead of the local day."""
        return shift_months(self.local_today, 12)

    @property
    def window_start(self) -> datetime:
        return datetime.combine(shift_months(self.today, -self.analysis_window_months), time())

    @property
    def now(self) -> Column:
        """``as_of`` as a zoneless timestamp literal."""
        return instant(self.as_of)


def instant(moment: datetime | date) -> Column:
    """A zoneless timestamp literal that does not depend on the session time zone."""
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


@dataclass(frozen=True)
class RunPlan:
    sources: frozenset[str]
    backfill: bool

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> RunPlan:
        """Which feeds to run: a comma list (blank entries ignored, unknown names run nothing)."""
        env = os.environ if env is None else env
        names = env.get("DESKWISE_SOURCES", ",".join(ALL_SOURCES)).split(",")
        wanted = {n.strip() for n in names} & set(ALL_SOURCES)
        return cls(frozenset(wanted), env.get("DESKWISE_BACKFILL", "").lower() in TRUE_WORDS)
