"""The lifecycle fact, the daily service-level fact and the status history's source."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.functions import bands
from deskwise.functions.keys import surrogate_key
from deskwise.functions.rates import ratio
from deskwise.functions.timing import last_moved, reportable_hours
from deskwise.operators import counting
from deskwise.operators.spine import between_scalars, per_member
from deskwise.operators.upsert import lookback_filter, merge_rows
from deskwise.plans.dimensions import UNKNOWN_CODE
from deskwise.settings import Settings, instant

# Service-level thresholds in whole hours.
ONE_DAY = 24
THREE_DAYS = 72

DAILY_KEYS = ["service_date", "borough_name", "service_category"]

FACT_COLUMNS = [
    "request_id",
    "complaint_category_key",
    "agency_key",
    "location_key",
    "weather_band_key",
    "created_date_local",
    "closed_date_local",
    "created_at",
    "resolution_updated_at",
    "closed_at",
    "complaint_type",
    "descriptor",
    "service_category",
    "service_subcategory",
    "agency_code",
    "borough_name",
    "incident_zip",
    "status",
    "channel_type",
    "latitude",
    "longitude",
    "resolution_hours",
    "resolution_days",
    "is_closed",
    "is_weather_sensitive",
    "is_unmapped_complaint_type",
    "is_implausible_resolution",
    "reportable_resolution_hours",
    "dlt_load_id",
]


def unknown_band_key():
    return surrogate_key(*[F.lit(bands.UNKNOWN)] * 3)


def in_window(requests: DataFrame, settings: Settings, dim_date: DataFrame) -> DataFrame:
    """Requests created inside the analytical window and not before the calendar begins.

    Two predicates rather than one ``greatest``: the window start is a literal that reaches the
    Parquet scan, the calendar's first day a scalar subquery.
    """
    first_day = dim_date.agg(F.min("date_key").cast("timestamp_ntz")).scalar()
    return requests.where(
        (F.col("created_at") >= instant(settings.window_start)) & (F.col("created_at") >= first_day)
    )


def fct_requests(
    requests: DataFrame,
    weather: DataFrame,
    dim_date: DataFrame,
    settings: Settings,
    target: DataFrame | None = None,
) -> DataFrame:
    """One row per request with its milestones, lags and keys.

    With a ``target`` this is the incremental batch: only requests that moved within the lookback.
    """
    rows = in_window(requests, settings, dim_date)
    rows = lookback_filter(rows, target, "resolution_updated_at", "created_at", settings)
    agency = F.coalesce("agency_code", F.lit(UNKNOWN_CODE))
    borough = F.coalesce("borough_name", F.lit(UNKNOWN_CODE))
    daily = weather.select(
        F.col("weather_date").alias("created_date_local"), F.col("weather_band_key").alias("__band")
    )
    return (
        rows.join(daily, "created_date_local", "left")
        .withColumns(
            {
                "agency_code": agency,
                "borough_name": borough,
                "agency_key": surrogate_key(agency),
                "location_key": surrogate_key(borough),
                "weather_band_key": F.coalesce("__band", unknown_band_key()),
                "reportable_resolution_hours": reportable_hours(
                    F.col("is_closed"), F.col("is_implausible_resolution"), F.col("resolution_hours")
                ),
            }
        )
        .select(*FACT_COLUMNS)
    )


def merged_requests(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The accumulating snapshot after a batch: changed requests replaced in place."""
    return merge_rows(target, batch, ["request_id"])


def daily_measures(fact: DataFrame) -> DataFrame:
    """Demand and service per day, borough and category.

    A request counts on the day it arrived and again on the day it closed. Both roles come from one
    scan: each row yields up to two (day, hours) entries, which a single hash aggregate turns into
    counts per whole hour. Every measure, percentiles included, is then read off those counts.
    """
    opened = F.struct(
        F.col("created_date_local").alias("service_date"),
        F.lit(None).cast("bigint").alias("hours"),
        F.lit(1).cast("bigint").alias("opened"),
        F.lit(0).cast("bigint").alias("closed"),
    )
    closed = F.struct(
        F.when(F.col("is_closed"), F.col("closed_date_local")).alias("service_date"),
        F.col("reportable_resolution_hours").alias("hours"),
        F.lit(0).cast("bigint").alias("opened"),
        F.lit(1).cast("bigint").alias("closed"),
    )
    counts = (
        fact.select("borough_name", "service_category", F.inline(F.array(opened, closed)))
        .where(F.col("service_date").isNotNull())
        .groupBy(*DAILY_KEYS, "hours")
        .agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    )
    hours = F.col("hours")
    return (
        counting.running_counts(counts, DAILY_KEYS, "hours", "closed")
        .groupBy(*DAILY_KEYS)
        .agg(
            F.sum("opened").alias("requests_created"),
            F.sum("closed").alias("requests_closed"),
            counting.mean("hours", "closed").alias("avg_resolution_hours"),
            counting.percentile("hours", 50).alias("median_resolution_hours"),
            counting.percentile("hours", 90).alias("p90_resolution_hours"),
            counting.total("closed", hours <= ONE_DAY).alias("closed_within_1_day"),
            counting.total("closed", hours <= THREE_DAYS).alias("closed_within_3_days"),
            counting.total("closed", hours.isNotNull()).alias("closures_measured"),
        )
    )


def daily_spine(
    dim_date: DataFrame, dim_location: DataFrame, dim_category: DataFrame, fact: DataFrame
) -> DataFrame:
    """Every day × borough × category within the fact's range of created days."""
    days = between_scalars(
        dim_date.select(F.col("date_key").alias("service_date")),
        F.col("service_date"),
        fact.agg(F.min("created_date_local")),
        fact.agg(F.max("created_date_local")),
    )
    places = per_member(days, "borough_name", dim_location)
    return per_member(places, "service_category", dim_category)


def fct_daily(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
    dim_category: DataFrame,
    weather: DataFrame,
) -> DataFrame:
    """Dense periodic snapshot: quiet days are rows of zeros, their averages null."""
    spine = daily_spine(dim_date, dim_location, dim_category, fact)
    days = weather.select(
        F.col("weather_date").alias("service_date"),
        F.col("weather_band_key").alias("__band"),
        "temp_mean_f",
        "precipitation_in",
        "snowfall_in",
        "temp_band",
        "precip_band",
        "snow_band",
    )
    counters = [
        "requests_created",
        "requests_closed",
        "closed_within_1_day",
        "closed_within_3_days",
        "closures_measured",
    ]
    joined = spine.join(daily_measures(fact), DAILY_KEYS, "left").join(days, "service_date", "left")
    counted = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counters})
    return counted.select(
        *DAILY_KEYS,
        surrogate_key(*DAILY_KEYS).alias("daily_service_level_key"),
        surrogate_key("borough_name").alias("location_key"),
        F.coalesce("__band", unknown_band_key()).alias("weather_band_key"),
        "requests_created",
        "requests_closed",
        "avg_resolution_hours",
        "median_resolution_hours",
        "p90_resolution_hours",
        "closed_within_1_day",
        "closed_within_3_days",
        "closures_measured",
        ratio(F.col("closed_within_3_days"), F.col("closures_measured")).alias(
            "pct_closed_within_3_days"
        ),
        "temp_mean_f",
        "precipitation_in",
        "snowfall_in",
        "temp_band",
        "precip_band",
        "snow_band",
    )


def snapshot_source(staged: DataFrame, settings: Settings) -> DataFrame:
    """Requests whose status is tracked: still open, or closed within the snapshot window."""
    horizon = instant(settings.as_of - timedelta(days=settings.snapshot_window_days))
    return staged.where(F.col("closed_at").isNull() | (F.col("closed_at") >= horizon)).select(
        "request_id",
        "status",
        "agency_code",
        "complaint_type",
        "borough_name",
        "created_at",
        "closed_at",
        "resolution_updated_at",
        last_moved(F.col("resolution_updated_at"), F.col("created_at")).alias("status_changed_at"),
    )
