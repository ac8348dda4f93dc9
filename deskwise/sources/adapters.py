"""Views of the benchmark tables in the shape of the two feeds.

``events`` become requests with times of day, ``orders`` become requests with long durations, and
daily totals of ``events`` become weather observations. All are plain projections or aggregates, so
their work grows with the tables.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.operators.spine import literal_table
from deskwise.settings import Settings, instant
from deskwise.sources import schemas

# The clock of the event-based runs, and the earlier and later extracts of the history runs.
EVENTS_AS_OF = datetime(2024, 2, 1)
FIRST_EXTRACT = datetime(2024, 1, 15)
SECOND_EXTRACT = datetime(2024, 1, 30)
# The orders reach back years: their window starts in the middle of the table.
ORDERS_AS_OF = datetime(2000, 1, 1)

EVENTS = Settings(as_of=EVENTS_AS_OF)
# A short lookback and status scope, so that both leave rows out of a thirty-day table.
FIRST = Settings(as_of=FIRST_EXTRACT, incremental_lookback_days=5, snapshot_window_days=7)
SECOND = Settings(as_of=SECOND_EXTRACT, incremental_lookback_days=5, snapshot_window_days=7)
ORDERS = Settings(as_of=ORDERS_AS_OF, spine_start=date(1995, 1, 1))

BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "Unspecified", ""]

# Four of the five event types are mapped; 'error' is left to the unmapped member.
EVENT_SEED = [
    ("view", "Housing & Buildings", "Heat & Hot Water", True),
    ("click", "Housing & Buildings", "Elevators", False),
    ("signup", "Streets & Sidewalks", "Potholes", True),
    ("purchase", "Noise", "Residential Noise", False),
]
# Four of the five order priorities are mapped.
ORDER_SEED = [
    ("1-URGENT", "Emergency", "Heat & Hot Water", True),
    ("2-HIGH", "Emergency", "Flooding", True),
    ("3-MEDIUM", "Routine", "Repairs", False),
    ("5-LOW", "Routine", "Inspections", False),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schemas.SEED, EVENT_SEED)


def order_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schemas.SEED, ORDER_SEED)


def minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def requests_from_events(events: DataFrame) -> DataFrame:
    """The landed request schema, with every oddity the staging layer has to clean."""
    event, user, moment = F.col("event_id"), F.col("user_id"), F.col("ts")
    closed = (
        F.when(event % 11 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(event % 97 == 0, moment - minutes(F.lit(90)))
        .when(event % 101 == 0, moment + minutes(F.lit(600000)))
        .otherwise(moment + minutes(F.floor(F.col("value") * 100)))
    )
    desk = (user % 6).cast("string")
    agency = F.when(user % 6 < 4, F.concat(F.lit(" A"), desk)).when(user % 6 == 5, F.lit("  "))
    name = F.concat(F.when(moment < instant(date(2024, 1, 16)), F.lit("Desk ")).otherwise(F.lit("Bureau ")), desk)
    borough = F.get(F.array(*[F.lit(b) for b in BOROUGHS]), (user % 8).cast("int"))
    return events.select(
        event.cast("string").alias("unique_key"),
        moment.alias("created_date"),
        closed.alias("closed_date"),
        closed.alias("resolution_action_updated_date"),
        agency.alias("agency"),
        F.when(event % 5 != 0, name).alias("agency_name"),
        F.concat(F.col("event_type"), F.lit(" ")).alias("complaint_type"),
        F.col("props").alias("descriptor"),
        F.lit(" \t").alias("location_type"),
        (F.lit(10000) + user % 500).cast("string").alias("incident_zip"),
        borough.alias("borough"),
        F.when(closed.isNull(), "Open").otherwise("Closed").alias("status"),
        F.when(event % 3 == 0, "PHONE").otherwise("ONLINE").alias("open_data_channel_type"),
        F.when(event % 13 == 0, "n/a")
        .otherwise(F.concat(F.lit("40."), (F.lit(400) + user % 600).cast("string")))
        .alias("latitude"),
        F.concat(F.lit("-73."), (F.lit(600) + user % 400).cast("string")).alias("longitude"),
        F.concat(F.lit("load-"), F.date_format(moment, "yyyyMMdd")).alias(schemas.LOAD_ID),
    )


def extract_as_of(raw: DataFrame, as_of: datetime) -> DataFrame:
    """What the feed would have returned at ``as_of``: closures still to come are not there yet."""
    known = F.col("closed_date") <= instant(as_of)
    closed = F.when(known, F.col("closed_date"))
    return raw.where(F.col("created_date") <= instant(as_of)).withColumns(
        {
            "closed_date": closed,
            "resolution_action_updated_date": closed,
            "status": F.when(closed.isNull(), "Open").otherwise("Closed"),
        }
    )


def requests_from_orders(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Orders as requests closed by their last shipment; the region stands for the borough."""
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("closed_date")
    )
    places = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "r_regionkey")
    )
    borough = F.get(F.array(*[F.lit(b) for b in BOROUGHS[:5]]), F.col("r_regionkey").cast("int"))
    status = F.col("o_orderstatus")
    return (
        orders.join(shipped, "o_orderkey", "left")
        .join(places, "o_custkey", "left")
        .select(
            F.col("o_orderkey").cast("string").alias("unique_key"),
            F.col("o_orderdate").alias("created_date"),
            "closed_date",
            F.col("closed_date").alias("resolution_action_updated_date"),
            F.concat(F.lit("B"), (F.col("o_custkey") % 7).cast("string")).alias("agency"),
            F.concat(F.lit("Branch "), (F.col("o_custkey") % 7).cast("string")).alias("agency_name"),
            F.col("o_orderpriority").alias("complaint_type"),
            F.lit(None).cast("string").alias("descriptor"),
            F.lit(None).cast("string").alias("location_type"),
            F.lit(None).cast("string").alias("incident_zip"),
            borough.alias("borough"),
            F.when(status == "F", "Closed").when(status == "P", "Pending").otherwise("Open").alias("status"),
            F.lit("ONLINE").alias("open_data_channel_type"),
            F.lit(None).cast("string").alias("latitude"),
            F.lit(None).cast("string").alias("longitude"),
            F.lit("load-orders").alias(schemas.LOAD_ID),
        )
    )


def weather_from(rows: DataFrame, moment: str, one: str, other: str) -> DataFrame:
    """One observation per UTC day of a table, with every seventh day of the month missing.

    Only remainders are summed, so the totals cannot overflow however large the table is.
    """
    first, second = F.col(one), F.col(other)
    daily = (
        rows.select(F.col(moment).cast("date").alias("observed_on"), one, other)
        .where(F.dayofmonth("observed_on") % 7 != 0)
        .groupBy("observed_on")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(first % 45).alias("e45"),
            F.sum(first % 110).alias("e110"),
            F.sum(second % 240).alias("u240"),
        )
    )
    mean = ((F.col("e45") + F.col("n")) % 45 - 10).cast("double")
    rain = F.greatest(F.col("u240") % 240 - 60, F.lit(0)) / F.lit(10.0)
    snow = F.greatest(F.col("e110") % 110 - 50, F.lit(0)) / F.lit(10.0)
    return daily.select(
        "observed_on",
        (mean + 5).alias("temperature_2m_max"),
        (mean - 5).alias("temperature_2m_min"),
        mean.alias("temperature_2m_mean"),
        rain.alias("precipitation_sum"),
        rain.alias("rain_sum"),
        snow.alias("snowfall_sum"),
        (F.col("n") % 60).cast("double").alias("wind_speed_10m_max"),
        F.lit("load-weather").alias(schemas.LOAD_ID),
    )


def weather_from_events(events: DataFrame) -> DataFrame:
    return weather_from(events, "ts", "event_id", "user_id")


def weather_from_orders(orders: DataFrame) -> DataFrame:
    return weather_from(orders, "o_orderdate", "o_orderkey", "o_custkey")


def loads_from_events(events: DataFrame) -> DataFrame:
    """One load per day of events; every fifth day's load did not complete."""
    return events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.max("ts").alias("inserted_at")
    ).select(
        F.concat(F.lit("load-"), F.date_format("day", "yyyyMMdd")).alias("load_id"),
        F.when(F.dayofmonth("day") % 5 == 0, 1).otherwise(0).cast("bigint").alias("status"),
        "inserted_at",
    )
