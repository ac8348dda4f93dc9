"""Declared schemas at every landing boundary. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The field names of the two feeds, in landing order.
REQUEST_FIELDS = [
    "unique_key",
    "created_date",
    "closed_date",
    "resolution_action_updated_date",
    "agency",
    "agency_name",
    "complaint_type",
    "descriptor",
    "location_type",
    "incident_zip",
    "borough",
    "status",
    "open_data_channel_type",
    "latitude",
    "longitude",
]
WEATHER_VARIABLES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_10m_max",
]
LOAD_ID = "_dlt_load_id"

# The request feed sends every value as text; casting is the staging layer's job.
REQUESTS = T.StructType([T.StructField(name, T.StringType()) for name in REQUEST_FIELDS])

WEATHER = T.StructType(
    [T.StructField("observed_on", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in WEATHER_VARIABLES]
    + [T.StructField("_extracted_at", T.TimestampNTZType()), T.StructField(LOAD_ID, T.StringType())]
)

# The weather feed sends one object holding parallel arrays, one per variable.
WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in WEATHER_VARIABLES]
            ),
        )
    ]
)

SEED = T.StructType(
    [
        T.StructField("complaint_type", T.StringType()),
        T.StructField("service_category", T.StringType()),
        T.StructField("service_subcategory", T.StringType()),
        T.StructField("is_weather_sensitive", T.BooleanType()),
    ]
)

LOADS = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
    ]
)

CURSORS = T.StructType(
    [
        T.StructField("cursor_name", T.StringType()),
        T.StructField("cursor_value", T.TimestampNTZType()),
        T.StructField("committed_at", T.TimestampNTZType()),
    ]
)

# Files that runs have taken from the landing folder, and the chunks among them.
LANDED_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("landed_at", T.TimestampNTZType()),
        T.StructField("length", T.LongType()),
        T.StructField("walk", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("load_id", T.StringType()),
    ]
)
