"""Landed tables, renamed, trimmed and cast. No joins and no business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.functions.cleaning import as_instant, blank_to_null, number_or_null, sentinel_to_null
from deskwise.functions.rates import fahrenheit, inches
from deskwise.sources.schemas import LOAD_ID

# Output name of each landed text column.
TEXT_COLUMNS = {
    "agency": "agency_code",
    "agency_name": "agency_name",
    "complaint_type": "complaint_type",
    "descriptor": "descriptor",
    "location_type": "location_type",
    "incident_zip": "incident_zip",
    "borough": "borough_name",
    "status": "status",
    "open_data_channel_type": "channel_type",
}
MOMENT_COLUMNS = {
    "created_date": "created_at",
    "closed_date": "closed_at",
    "resolution_action_updated_date": "resolution_updated_at",
}
# Fixed value: how the feed spells a missing borough.
NO_BOROUGH = "Unspecified"

MM_PER_INCH = 25.4
CM_PER_INCH = 2.54


def stg_requests(raw: DataFrame) -> DataFrame:
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    moments = [as_instant(c, dtypes[c]).alias(name) for c, name in MOMENT_COLUMNS.items()]
    texts = [
        (sentinel_to_null(c, NO_BOROUGH) if c == "borough" else blank_to_null(c)).alias(name)
        for c, name in TEXT_COLUMNS.items()
    ]
    places = [number_or_null(c).alias(c) for c in ("latitude", "longitude")]
    return raw.select(
        F.col("unique_key").alias("request_id"),
        *moments,
        *texts,
        *places,
        F.col(LOAD_ID).alias("dlt_load_id"),
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    celsius = {name: F.col(f"temperature_2m_{name}") for name in ("max", "min", "mean")}
    return raw.select(
        F.col("observed_on").alias("weather_date"),
        *[c.alias(f"temp_{name}_c") for name, c in celsius.items()],
        *[fahrenheit(c).alias(f"temp_{name}_f") for name, c in celsius.items()],
        F.col("precipitation_sum").alias("precipitation_mm"),
        F.col("rain_sum").alias("rain_mm"),
        F.col("snowfall_sum").alias("snowfall_cm"),
        F.col("wind_speed_10m_max").alias("wind_speed_max_kmh"),
        inches(F.col("precipitation_sum"), MM_PER_INCH).alias("precipitation_in"),
        inches(F.col("snowfall_sum"), CM_PER_INCH).alias("snowfall_in"),
        F.col(LOAD_ID).alias("dlt_load_id"),
    )
