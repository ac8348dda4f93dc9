"""Report extracts over the marts, and the page queries over those extracts.

Every extract collapses the fact with one map-side-combining aggregate before it joins anything, so
the page queries work on thousands of rows. Parameters are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskwise.functions.rates import ratio, to_bucket, weighted_mean
from deskwise.operators import counting
from deskwise.operators.spine import one_row
from deskwise.plans.dimensions import UNKNOWN_CODE
from deskwise.plans.facts import THREE_DAYS
from deskwise.settings import Settings

# Fixed value: the subcategory whose volume follows the heating statute.
HEAT = "Heat & Hot Water"
# Group sizes below which a rate is not reported.
MIN_AGENCY_REQUESTS = 1000
MIN_SELECTED_REQUESTS = 50
MIN_TREND_CLOSURES = 200
MIN_WEATHER_CLOSURES = 500
MIN_BUCKET_DAYS = 5
# Rows shown by the two ranked tables, and the days behind that raise a warning.
AGENCY_ROWS = 15
SELECTED_ROWS = 20
MAX_DAYS_BEHIND = 4

NO_BAND = "Unknown"


def _share_within_3_days() -> Column:
    return ratio(F.sum("closed_within_3_days"), F.sum("closures_measured")).alias(
        "pct_closed_within_3_days"
    )


def _mean_hours() -> Column:
    return weighted_mean("avg_resolution_hours", "closures_measured").alias("avg_resolution_hours")


# Extracts


def agency_performance(fact: DataFrame, dim_agency: DataFrame) -> DataFrame:
    """Service level by agency, borough and category, percentiles taken from the requests."""
    keys = ["agency_key", "borough_name", "service_category"]
    counts = fact.groupBy(*keys, F.col("reportable_resolution_hours").alias("hours")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_closed").alias("closed")
    )
    hours = F.col("hours")
    measured = (
        counting.running_counts(counts, keys, "hours", "n")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("requests_total"),
            F.sum("closed").alias("requests_closed"),
            counting.mean("hours", "n").alias("avg_resolution_hours"),
            counting.percentile("hours", 50).alias("median_resolution_hours"),
            counting.percentile("hours", 90).alias("p90_resolution_hours"),
            counting.total("n", hours.isNotNull()).alias("closures_measured"),
            counting.total("n", hours <= THREE_DAYS).alias("closed_within_3_days"),
        )
    )
    return measured.join(dim_agency, "agency_key").select(
        "agency_code",
        "agency_name",
        "borough_name",
        "service_category",
        "requests_total",
        "requests_closed",
        (F.col("requests_total") - F.col("requests_closed")).alias("requests_open"),
        "avg_resolution_hours",
        "median_resolution_hours",
        "p90_resolution_hours",
        "closures_measured",
        "closed_within_3_days",
        ratio(F.col("closed_within_3_days"), F.col("closures_measured")).alias(
            "pct_closed_within_3_days"
        ),
    )


def daily_extract(daily: DataFrame) -> DataFrame:
    keys = ["daily_service_level_key", "location_key", "weather_band_key"]
    return daily.drop(*keys).orderBy("service_date")


def heat_season(dim_date: DataFrame, fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Heat requests per day beside the season flag and the temperature. Days without requests
    have no row. The fact is reduced to one row per day before it meets the calendar."""
    is_heat = F.col("service_subcategory") == HEAT
    per_day = fact.groupBy(F.col("created_date_local").alias("service_date")).agg(
        F.count_if(is_heat).alias("heat_requests"),
        F.count_if(~is_heat).alias("other_requests"),
        F.avg(F.when(is_heat, F.col("reportable_resolution_hours"))).alias("heat_avg_resolution_hours"),
    )
    # One temperature per day, repeated over the daily mart's boroughs and categories.
    temperature = daily.groupBy("service_date").agg(F.max("temp_mean_f").alias("temp_mean_f"))
    days = dim_date.select(F.col("date_key").alias("service_date"), "is_heat_season")
    return (
        days.join(per_day, "service_date")
        .join(temperature, "service_date", "left")
        .select(
            "service_date",
            "is_heat_season",
            "temp_mean_f",
            "heat_requests",
            "other_requests",
            "heat_avg_resolution_hours",
        )
        .orderBy("service_date")
    )


def pipeline_freshness(loads: DataFrame, fact: DataFrame, settings: Settings) -> DataFrame:
    """One row of scalars: when data last arrived, and how far it reaches."""
    done = loads.where(F.col("status") == 0)
    requests = fact.agg(F.max("created_at").alias("latest_request_at"), F.count(F.lit(1)).alias("n"))
    ledger = done.agg(F.max("inserted_at").alias("last_load_at"), F.count(F.lit(1)).alias("n"))
    return one_row(fact.sparkSession).select(
        ledger.select("last_load_at").scalar().alias("last_load_at"),
        ledger.select("n").scalar().alias("loads_total"),
        requests.select("latest_request_at").scalar().alias("latest_request_at"),
        requests.select("n").scalar().alias("requests_total"),
        settings.now.alias("built_at"),
    )


# Overview page


def freshness_banner(freshness: DataFrame, settings: Settings) -> DataFrame:
    behind = F.datediff(F.lit(settings.today), F.col("latest_request_at").cast("date"))
    return freshness.select(
        "last_load_at",
        "latest_request_at",
        "requests_total",
        behind.alias("days_behind"),
        F.when(behind > MAX_DAYS_BEHIND, "warning").otherwise("info").alias("banner_status"),
    )


def citywide_daily(extract: DataFrame) -> DataFrame:
    totals = [F.sum(c).alias(c) for c in ("requests_created", "requests_closed")]
    return extract.groupBy("service_date").agg(*totals).orderBy("service_date")


def agency_rollup(performance: DataFrame, min_requests: int = MIN_AGENCY_REQUESTS) -> DataFrame:
    return (
        performance.groupBy("agency_code", "agency_name")
        .agg(
            F.sum("requests_total").alias("requests_total"),
            F.sum("closures_measured").alias("closures_measured"),
            _share_within_3_days(),
            _mean_hours(),
        )
        .where(F.col("requests_total") > min_requests)
        .orderBy(F.col("requests_total").desc(), "agency_code")
    )


def top_agencies(performance: DataFrame, min_requests: int = MIN_AGENCY_REQUESTS) -> DataFrame:
    """The rows the overview table shows."""
    return agency_rollup(performance, min_requests).limit(AGENCY_ROWS)


def by_borough_category(extract: DataFrame) -> DataFrame:
    return (
        extract.where(F.col("borough_name") != UNKNOWN_CODE)
        .groupBy("borough_name", "service_category")
        .agg(F.sum("requests_created").alias("requests_created"))
    )


def service_level_trend(extract: DataFrame, min_closures: int = MIN_TREND_CLOSURES) -> DataFrame:
    return (
        extract.groupBy(F.trunc("service_date", "month").alias("month"), "service_category")
        .agg(_share_within_3_days(), F.sum("closures_measured").alias("__closures"))
        .where(F.col("__closures") > min_closures)
        .drop("__closures")
        .orderBy("month", "service_category")
    )


# Agency page


def agencies(performance: DataFrame) -> DataFrame:
    return performance.select("agency_code", "agency_name").distinct().orderBy("agency_code")


def agency_selected(
    performance: DataFrame, agency_code: str, min_requests: int = MIN_SELECTED_REQUESTS
) -> DataFrame:
    return (
        performance.where(F.col("agency_code") == agency_code)
        .groupBy("borough_name", "service_category")
        .agg(
            F.sum("requests_total").alias("requests_total"),
            F.sum("requests_open").alias("requests_open"),
            F.sum("closures_measured").alias("closures_measured"),
            _mean_hours(),
            _share_within_3_days(),
        )
        .where(F.col("requests_total") > min_requests)
        .orderBy(F.col("requests_total").desc(), "borough_name", "service_category")
    )


def top_selected(
    performance: DataFrame, agency_code: str, min_requests: int = MIN_SELECTED_REQUESTS
) -> DataFrame:
    """The rows the agency table shows."""
    return agency_selected(performance, agency_code, min_requests).limit(SELECTED_ROWS)


def agency_totals(performance: DataFrame, agency_code: str) -> DataFrame:
    return performance.where(F.col("agency_code") == agency_code).agg(
        F.sum("requests_total").alias("requests_total"),
        F.sum("requests_open").alias("requests_open"),
        _mean_hours(),
    )


def agency_by_borough(performance: DataFrame, agency_code: str) -> DataFrame:
    chosen = (F.col("agency_code") == agency_code) & (F.col("borough_name") != UNKNOWN_CODE)
    return (
        performance.where(chosen)
        .groupBy("borough_name")
        .agg(_mean_hours())
        .orderBy(F.col("avg_resolution_hours").desc(), "borough_name")
    )


# Weather page


def heat_daily(heat: DataFrame) -> DataFrame:
    columns = ["service_date", "is_heat_season", "temp_mean_f", "heat_requests"]
    return heat.select(*columns).orderBy("service_date")


def heat_by_temperature(
    heat: DataFrame, in_season: bool, min_days: int = MIN_BUCKET_DAYS, width: int = 5
) -> DataFrame:
    """Mean daily heat requests by temperature bucket, inside or outside the heating season."""
    flag = F.col("is_heat_season") if in_season else ~F.col("is_heat_season")
    return (
        heat.where(flag & F.col("temp_mean_f").isNotNull())
        .groupBy(to_bucket(F.col("temp_mean_f"), width).alias("temp_bucket"))
        .agg(F.avg("heat_requests").alias("avg_heat_requests"), F.count(F.lit(1)).alias("days"))
        .where(F.col("days") >= min_days)
        .orderBy("temp_bucket")
    )


def by_weather(extract: DataFrame, min_closures: int = MIN_WEATHER_CLOSURES) -> DataFrame:
    return (
        extract.where(F.col("temp_band") != NO_BAND)
        .groupBy("temp_band", "precip_band")
        .agg(
            F.sum("requests_created").alias("requests_created"),
            _share_within_3_days(),
            F.sum("closures_measured").alias("__closures"),
        )
        .where(F.col("__closures") > min_closures)
        .drop("__closures")
    )


def snow_days(extract: DataFrame) -> DataFrame:
    return (
        extract.where(F.col("snow_band") != NO_BAND)
        .groupBy("snow_band")
        .agg(F.sum("requests_created").alias("requests_created"), _mean_hours())
    )
