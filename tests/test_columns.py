from datetime import date, datetime, timedelta

import pytest
from helpers import ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwise.functions import bands, calendar, cleaning, keys, rates, timing
from deskwise.operators.spine import calendar as days
from deskwise.settings import RunPlan, Settings, shift_months


def one(spark, ddl, values, *columns):
    return [tuple(r) for r in spark.createDataFrame(values, ddl).select(*columns).collect()]


def test_blank_text_becomes_null_whatever_the_white_space(spark):
    values = [("  a b ",), ("",), (" \t\n",), ("\u2003x\u3000",), (None,), ("Unspecified ",), ("unspecified",)]
    got = one(spark, "v string", values, cleaning.blank_to_null("v"), cleaning.sentinel_to_null("v", "Unspecified"))
    assert [g[0] for g in got] == ["a b", None, None, "x", None, "Unspecified", "unspecified"]
    assert [g[1] for g in got][-2:] == [None, "unspecified"]


def test_bad_numbers_become_null(spark):
    got = one(spark, "v string", [("40.5",), ("n/a",), ("",), (None,)], cleaning.number_or_null("v"))
    assert [g[0] for g in got] == [40.5, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_landed_instants_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        zoned = spark.range(1).select(F.timestamp_seconds(F.lit(1768525200)).alias("t"))
        text = spark.range(1).select(F.lit("2026-01-16T01:00:00.000").alias("t"))
        for frame in (zoned, text):
            moment = cleaning.as_instant("t", frame.schema["t"].dataType)
            day = timing.local_day(moment, "UTC", "America/New_York", zone)
            row = frame.select(moment.alias("m"), day.alias("d")).first()
            assert (row["m"], row["d"]) == (datetime(2026, 1, 16, 1), date(2026, 1, 15))
            assert frame.select(moment.alias("m")).schema["m"].dataType == T.TimestampNTZType()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("session", ["UTC", None])
def test_local_day_is_new_yorks(spark, session):
    moments = [
        ("2026-01-16T01:00:00", date(2026, 1, 15)),
        ("2026-01-15T12:00:00", date(2026, 1, 15)),
        # Summer time: midnight there is 04:00 UTC, in winter 05:00.
        ("2026-07-01T03:59:59", date(2026, 6, 30)),
        ("2026-07-01T04:00:00", date(2026, 7, 1)),
        ("2026-01-01T04:59:59", date(2025, 12, 31)),
        ("2026-01-01T05:00:00", date(2026, 1, 1)),
        ("1969-12-31T23:59:59.9", date(1969, 12, 31)),
    ]
    got = one(
        spark,
        "m timestamp_ntz",
        [(ts(m),) for m, _ in moments],
        timing.local_day(F.col("m"), "UTC", "America/New_York", session),
    )
    assert [g[0] for g in got] == [d for _, d in moments]


def test_local_wall_clock_feeds_can_be_declared(spark):
    day = timing.local_day(F.col("m"), "America/New_York", "America/New_York", "UTC")
    assert one(spark, "m timestamp_ntz", [(ts("2026-01-16T01:00:00"),)], day) == [(date(2026, 1, 16),)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_are_whole_and_truncate_toward_zero(spark, zone):
    start = datetime(2026, 3, 7, 12)
    gaps = {
        timedelta(hours=24, minutes=59): 24,
        timedelta(hours=-25, minutes=-30): -25,
        timedelta(minutes=-59): 0,
        # Across the spring clock change of the session zone.
        timedelta(days=2): 48,
        timedelta(days=365): 8760,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(start, start + g) for g in gaps]
        got = one(spark, "a timestamp_ntz, b timestamp_ntz", rows, timing.elapsed_hours(F.col("a"), F.col("b")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [g[0] for g in got] == list(gaps.values())


def test_implausible_boundaries(spark):
    start = datetime(2025, 1, 1)
    cases = {
        timedelta(hours=8760): False,
        timedelta(hours=8760, minutes=59): False,
        timedelta(hours=8761): True,
        timedelta(minutes=-1): True,
        timedelta(days=364): False,
    }
    rows = [(start, start + gap) for gap in cases] + [(start, None)]
    hours = timing.elapsed_hours(F.col("a"), F.col("b"))
    flag = timing.is_implausible(F.col("a"), F.col("b"), hours)
    got = one(spark, "a timestamp_ntz, b timestamp_ntz", rows, flag)
    assert [g[0] for g in got] == [*cases.values(), False]


def test_ladders_at_every_threshold(spark):
    cases = {
        bands.TEMPERATURE: {
            31.9: "Freezing", 32.0: "Cold", 49.9: "Cold", 50.0: "Mild", 69.9: "Mild",
            70.0: "Warm", 84.9: "Warm", 85.0: "Hot", None: "Unknown",
        },
        bands.PRECIPITATION: {
            0.0: "None", 0.01: "Light", 0.09: "Light", 0.1: "Moderate", 0.49: "Moderate",
            0.5: "Heavy", None: "Unknown",
        },
        bands.SNOW: {0.0: "None", 0.1: "Light", 1.99: "Light", 2.0: "Significant", None: "Unknown"},
    }
    for ladder, expected in cases.items():
        got = one(spark, "v double", [(v,) for v in expected], ladder.of(F.col("v")))
        assert [g[0] for g in got] == list(expected.values())
        assert {g[0] for g in got} == set(ladder.members)


def test_surrogate_keys_tell_null_from_text(spark):
    import hashlib

    key = keys.surrogate_key("a", "b")
    got = one(spark, "a string, b int", [("x", 1), (None, 1), ("", 1)], key)
    texts = ["x-1", "_dbt_utils_surrogate_key_null_-1", "-1"]
    assert [g[0] for g in got] == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_rates(spark):
    got = one(
        spark,
        "a bigint, b bigint",
        [(1, 2), (1, 0), (None, 2)],
        rates.ratio(F.col("a"), F.col("b")),
    )
    assert [g[0] for g in got] == [0.5, None, None]
    frame = spark.createDataFrame([(10.0, 3), (20.0, 1), (None, 0)], "m double, n bigint")
    assert frame.agg(rates.weighted_mean("m", "n")).first()[0] == 12.5
    assert frame.where("n = 0").agg(rates.weighted_mean("m", "n")).first()[0] is None
    got = one(spark, "v double", [(32.4,), (32.5,), (-2.5,)], rates.to_bucket(F.col("v"), 5))
    assert [g[0] for g in got] == [30.0, 35.0, -5.0]
    got = one(spark, "v double", [(-0.03,), (25.4,)], rates.fahrenheit(F.col("v")), rates.inches(F.col("v"), 25.4))
    assert got == [(31.9, -0.0), (77.7, 1.0)]


def test_calendar_matches_the_standard_library(spark):
    table = days(spark, date(2023, 1, 1), date(2025, 3, 1))
    rows = table.select("date_key", *calendar.day_attributes(F.col("date_key"))).collect()
    assert len(rows) == (date(2025, 3, 1) - date(2023, 1, 1)).days
    for r in rows:
        d = r["date_key"]
        assert (r["calendar_year"], r["calendar_month"]) == (d.year, d.month)
        assert r["calendar_quarter"] == (d.month + 2) // 3
        assert (r["month_name"], r["day_name"], r["year_month"]) == (
            d.strftime("%B"),
            d.strftime("%A"),
            d.strftime("%Y-%m"),
        )
        assert r["day_of_week"] == d.isoweekday() % 7 + 1
        assert r["is_weekend"] == (d.weekday() >= 5)
        assert r["week_start_date"] == d - timedelta(days=d.weekday())
        assert r["month_start_date"] == d.replace(day=1)
        assert r["is_heat_season"] == (d.month >= 10 or d.month <= 5)
        assert r["season"] == {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                               6: "Summer", 7: "Summer", 8: "Summer"}.get(d.month, "Autumn")
    assert days(spark, date(2023, 1, 1), date(2023, 1, 1)).count() == 0


def test_settings_clock(spark):
    settings = Settings(as_of=datetime(2026, 3, 1, 3))
    assert settings.local_today == date(2026, 2, 28)
    assert settings.spine_end == date(2027, 2, 28)
    assert settings.window_start == datetime(2024, 3, 1)
    assert shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert shift_months(date(2024, 12, 31), 12) == date(2025, 12, 31)


def test_settings_come_from_the_environment_and_fail_loudly():
    assert Settings.from_env({}).max_chunks_per_run == 0
    assert Settings.from_env({"DESKWISE_BACKFILL_MONTHS": "6"}).backfill_months == 6
    with pytest.raises(ValueError):
        Settings.from_env({"DESKWISE_BACKFILL_MONTHS": "six"})


@pytest.mark.parametrize(
    ("env", "sources", "backfill"),
    [
        ({}, {"requests", "weather"}, False),
        ({"DESKWISE_SOURCES": "requests"}, {"requests"}, False),
        ({"DESKWISE_SOURCES": " weather , "}, {"weather"}, False),
        ({"DESKWISE_SOURCES": ""}, set(), False),
        ({"DESKWISE_SOURCES": "other"}, set(), False),
        ({"DESKWISE_BACKFILL": "TRUE"}, {"requests", "weather"}, True),
        ({"DESKWISE_BACKFILL": "Yes"}, {"requests", "weather"}, True),
        ({"DESKWISE_BACKFILL": "0"}, {"requests", "weather"}, False),
    ],
)
def test_run_selection(env, sources, backfill):
    plan = RunPlan.from_env(env)
    assert (set(plan.sources), plan.backfill) == (sources, backfill)
