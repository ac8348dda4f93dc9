"""Category hierarchy, resolution measures and weather bands. Lazy: never stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.functions import bands, timing
from deskwise.functions.keys import surrogate_key
from deskwise.settings import Settings

UNMAPPED = "Unmapped"


def int_requests(staged: DataFrame, seed: DataFrame, settings: Settings) -> DataFrame:
    """Requests with their category and measures. Types missing from the seed become 'Unmapped'.

    The seed carries the category's surrogate key through the join, so the hash is computed once per
    complaint type rather than once per request. The seed is a file (or local relation) of known
    size, so Catalyst broadcasts it only while it is below the broadcast threshold.
    """
    categories = seed.select(
        F.col("complaint_type").alias("__mapped_type"),
        "service_category",
        "service_subcategory",
        "is_weather_sensitive",
        surrogate_key("complaint_type").alias("complaint_category_key"),
    )
    hours = timing.elapsed_hours(F.col("created_at"), F.col("closed_at"))
    zones = (
        settings.source_tz,
        settings.local_tz,
        staged.sparkSession.conf.get("spark.sql.session.timeZone"),
    )
    defaults = {
        "service_category": F.lit(UNMAPPED),
        "service_subcategory": F.lit(UNMAPPED),
        "is_weather_sensitive": F.lit(False),
        "complaint_category_key": surrogate_key(F.lit(UNMAPPED)),
    }
    return (
        staged.join(categories, F.col("complaint_type") == F.col("__mapped_type"), "left")
        .withColumns({c: F.coalesce(F.col(c), default) for c, default in defaults.items()})
        .withColumns(
            {
                "is_unmapped_complaint_type": F.col("__mapped_type").isNull(),
                "created_date_local": timing.local_day(F.col("created_at"), *zones),
                "closed_date_local": timing.local_day(F.col("closed_at"), *zones),
                "is_closed": F.col("closed_at").isNotNull(),
                "resolution_hours": hours,
            }
        )
        .withColumns(
            {
                "resolution_days": timing.elapsed_days(F.col("resolution_hours")),
                "is_implausible_resolution": timing.is_implausible(
                    F.col("created_at"), F.col("closed_at"), F.col("resolution_hours")
                ),
            }
        )
        .drop("__mapped_type")
    )


def int_weather_banded(staged: DataFrame) -> DataFrame:
    """Each day's bands, taken from the rounded values that are reported."""
    return staged.select(
        "weather_date",
        "temp_max_f",
        "temp_min_f",
        "temp_mean_f",
        "precipitation_in",
        "snowfall_in",
        "wind_speed_max_kmh",
        bands.TEMPERATURE.of(F.col("temp_mean_f")).alias("temp_band"),
        bands.PRECIPITATION.of(F.col("precipitation_in")).alias("precip_band"),
        bands.SNOW.of(F.col("snowfall_in")).alias("snow_band"),
    ).withColumn("weather_band_key", surrogate_key("temp_band", "precip_band", "snow_band"))
