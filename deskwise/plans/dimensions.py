"""Conformed dimensions. Each has a member for "unknown", so every fact key has somewhere to point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.functions import bands
from deskwise.functions.calendar import day_attributes
from deskwise.functions.keys import surrogate_key
from deskwise.operators.spine import calendar, literal_table, product
from deskwise.operators.upsert import newest_per_key
from deskwise.plans.intermediate import UNMAPPED
from deskwise.settings import Settings

UNKNOWN_CODE = "UNKNOWN"

# The five boroughs and the member for requests without one.
LOCATIONS = [
    ("BRONX", "Bronx", 36005, "Bronx", True),
    ("BROOKLYN", "Brooklyn", 36047, "Kings", True),
    ("MANHATTAN", "Manhattan", 36061, "New York", True),
    ("QUEENS", "Queens", 36081, "Queens", True),
    ("STATEN ISLAND", "Staten Island", 36085, "Richmond", True),
    (UNKNOWN_CODE, "Unknown", None, None, False),
]
LOCATION_SCHEMA = (
    "borough_name string, borough_label string, county_fips bigint, county_name string, "
    "is_known_borough boolean"
)


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    days = calendar(spark, settings.spine_start, settings.spine_end)
    return days.select("date_key", *day_attributes(F.col("date_key")))


def dim_location(spark: SparkSession) -> DataFrame:
    members = literal_table(spark, LOCATION_SCHEMA, LOCATIONS)
    return members.select(surrogate_key("borough_name").alias("location_key"), "*")


def dim_category(seed: DataFrame) -> DataFrame:
    """Seed-driven, so a category keeps its row while nobody files under it."""
    catch_all = literal_table(
        seed.sparkSession, seed.schema, [(UNMAPPED, UNMAPPED, UNMAPPED, False)]
    )
    members = seed.unionByName(catch_all)
    return members.select(surrogate_key("complaint_type").alias("complaint_category_key"), "*")


def dim_weather_band(spark: SparkSession) -> DataFrame:
    temp, precip, snow = F.col("temp_band"), F.col("precip_band"), F.col("snow_band")
    return product(
        spark,
        temp_band=bands.TEMPERATURE.members,
        precip_band=bands.PRECIPITATION.members,
        snow_band=bands.SNOW.members,
    ).select(
        surrogate_key("temp_band", "precip_band", "snow_band").alias("weather_band_key"),
        "temp_band",
        "precip_band",
        "snow_band",
        F.concat(temp, F.lit(", "), precip, F.lit(" precip")).alias("weather_band_label"),
        temp.isin("Freezing", "Hot").alias("is_temperature_extreme"),
        ((precip == "Heavy") | (snow == "Significant")).alias("is_severe_precipitation"),
    )


def agency_sightings(staged: DataFrame) -> DataFrame:
    """The last sighting of each agency code under each name: a hash aggregate with a tiny result."""
    return (
        staged.where(F.col("agency_code").isNotNull())
        .groupBy("agency_code", "agency_name")
        .agg(F.max("created_at").alias("last_seen"))
    )


def later_sightings(sightings: DataFrame, more: DataFrame) -> DataFrame:
    """Sightings of earlier runs and of this one; the later of two under one name stays."""
    return sightings.unionByName(more).groupBy("agency_code", "agency_name").agg(F.max("last_seen").alias("last_seen"))


def dim_agency(staged: DataFrame) -> DataFrame:
    """One row per agency code, labelled with its latest non-null name.

    Requests are first reduced to sightings; only those are ranked. An agency with a third of all requests
    costs nothing extra.
    """
    return agencies_of(agency_sightings(staged))


def agencies_of(sightings: DataFrame) -> DataFrame:
    latest = newest_per_key(
        sightings,
        ["agency_code"],
        [F.col("agency_name").isNull(), F.col("last_seen").desc(), F.col("agency_name")],
    ).select(
        "agency_code",
        F.coalesce("agency_name", "agency_code").alias("agency_name"),
        F.lit(True).alias("is_known_agency"),
    )
    unknown = literal_table(sightings.sparkSession, latest.schema, [(UNKNOWN_CODE, "Unknown", False)])
    members = latest.unionByName(unknown)
    return members.select(surrogate_key("agency_code").alias("agency_key"), "*")
