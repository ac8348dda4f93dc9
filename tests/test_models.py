from datetime import date, datetime

from helpers import SETTINGS, request, rows_of, seed, staged
from pyspark.sql import functions as F

from deskwise.functions.keys import surrogate_key
from deskwise.operators.history import VALID_FROM
from deskwise.plans import checks, dimensions, facts, intermediate, reports, staging
from deskwise.settings import Settings
from deskwise.sources import schemas


def weather(spark, rows):
    """(day, mean °C, mm, cm) observations through staging and banding."""
    full = [(d, t, t, t, mm, mm, cm, 10.0, datetime(2026, 2, 1), "w") for d, t, mm, cm in rows]
    return intermediate.int_weather_banded(staging.stg_weather(spark.createDataFrame(full, schemas.WEATHER)))


def build(spark, requests, days=(), settings=SETTINGS):
    stg = staged(spark, requests)
    ints = intermediate.int_requests(stg, seed(spark), settings)
    dates = dimensions.dim_date(spark, settings)
    banded = weather(spark, list(days))
    fact = facts.fct_requests(ints, banded, dates, settings)
    daily = facts.fct_daily(
        fact, dates, dimensions.dim_location(spark), dimensions.dim_category(seed(spark)), banded
    )
    return stg, fact, daily


def test_unmapped_types_survive_the_join(spark):
    stg = staged(
        spark,
        [
            request("1", "2026-01-15T12:00:00", complaint_type="HEAT/HOT WATER"),
            request("2", "2026-01-15T12:00:00", complaint_type="Brand New Programme"),
            request("3", "2026-01-15T12:00:00", complaint_type=None),
        ],
    )
    got = rows_of(
        intermediate.int_requests(stg, seed(spark), SETTINGS),
        "request_id",
        "service_category",
        "service_subcategory",
        "is_weather_sensitive",
        "is_unmapped_complaint_type",
    )
    assert got == [
        ("1", "Housing & Buildings", "Heat & Hot Water", True, False),
        ("2", "Unmapped", "Unmapped", False, True),
        ("3", "Unmapped", "Unmapped", False, True),
    ]


def test_open_requests_have_no_measures(spark):
    stg = staged(
        spark,
        [
            request("open", "2026-01-01T00:00:00"),
            request("closed", "2026-01-01T00:00:00", "2026-01-03T00:00:00"),
        ],
    )
    ints = intermediate.int_requests(stg, seed(spark, []), SETTINGS)
    got = rows_of(ints, "request_id", "is_closed", "resolution_hours", "resolution_days")
    assert got == [("closed", True, 48, 2.0), ("open", False, None, None)]


def test_bands_use_the_rounded_values(spark):
    # -0.028 °C is 31.95 °F, reported as 32.0 (or 31.9 just below); 1 mm is 0.04 inches.
    banded = weather(spark, [(date(2026, 1, 1), -0.025, 1.0, 0.0), (date(2026, 1, 2), None, None, None)])
    got = rows_of(banded, "temp_mean_f", "temp_band", "precipitation_in", "precip_band", "snow_band")
    assert got == [(32.0, "Cold", 0.04, "Light", "None"), (None, "Unknown", None, "Unknown", "Unknown")]


def test_agency_takes_its_latest_name(spark):
    stg = staged(
        spark,
        [
            request("1", "2026-01-01T00:00:00", agency="A", agency_name="Old"),
            request("2", "2026-01-02T00:00:00", agency="A", agency_name="New"),
            request("3", "2026-01-03T00:00:00", agency="A", agency_name=" "),
            request("4", "2026-01-01T00:00:00", agency="B"),
            request("5", "2026-01-01T00:00:00", agency="C", agency_name="Tie b"),
            request("6", "2026-01-01T00:00:00", agency="C", agency_name="Tie a"),
            request("7", "2026-01-01T00:00:00", agency="  "),
        ],
    )
    got = rows_of(dimensions.dim_agency(stg), "agency_code", "agency_name", "is_known_agency")
    assert got == [
        ("A", "New", True),
        ("B", "B", True),
        ("C", "Tie a", True),
        ("UNKNOWN", "Unknown", False),
    ]


def test_fixed_dimensions(spark):
    assert dimensions.dim_weather_band(spark).count() == 120
    assert dimensions.dim_location(spark).count() == 6
    assert dimensions.dim_category(seed(spark)).count() == 2
    dates = dimensions.dim_date(spark, SETTINGS)
    ends = dates.agg(F.min("date_key"), F.max("date_key")).first()
    # The end is exclusive, and the local day of the clock is January 31.
    assert tuple(ends) == (date(2023, 1, 1), date(2027, 1, 30))


def test_window_starts_at_the_later_of_months_and_spine(spark):
    rows = [request("old", "2024-01-31T23:59:59"), request("in", "2024-02-01T00:00:00")]
    assert rows_of(build(spark, rows)[1], "request_id") == [("in",)]
    narrow = Settings(as_of=SETTINGS.as_of, spine_start=date(2025, 1, 1))
    rows.append(request("later", "2025-01-01T00:00:00"))
    assert rows_of(build(spark, rows, settings=narrow)[1], "request_id") == [("later",)]


def test_fact_keys_and_reportable_hours(spark):
    rows = [
        request("ok", "2026-01-05T12:00:00", "2026-01-06T12:30:00", complaint_type="HEAT/HOT WATER"),
        request("back", "2026-01-05T12:00:00", "2026-01-05T11:30:00", agency=" ", borough="Unspecified"),
    ]
    _, fact, _ = build(spark, rows, [(date(2026, 1, 5), 0.0, 0.0, 0.0)])
    got = {r["request_id"]: r for r in fact.collect()}
    assert got["ok"]["reportable_resolution_hours"] == 24
    assert (got["back"]["resolution_hours"], got["back"]["reportable_resolution_hours"]) == (0, None)
    assert (got["back"]["agency_code"], got["back"]["borough_name"]) == ("UNKNOWN", "UNKNOWN")
    key = spark.range(1).select(surrogate_key(F.lit("Cold"), F.lit("None"), F.lit("None"))).first()[0]
    assert got["ok"]["weather_band_key"] == key


def test_daily_is_dense_and_keeps_absence_apart_from_zero(spark):
    rows = [
        request("1", "2026-01-05T12:00:00", "2026-01-06T12:00:00"),
        request("2", "2026-01-07T12:00:00", "2026-01-07T13:00:00"),
        request("3", "2026-01-07T12:00:00", "2026-01-20T13:00:00"),
    ]
    _, fact, daily = build(spark, rows, [(date(2026, 1, 5), 0.0, 0.0, 0.0)])
    assert daily.count() == 3 * 6 * 2
    quiet = daily.where("service_date = '2026-01-05' and borough_name = 'QUEENS'").first()
    assert (quiet["requests_created"], quiet["requests_closed"]) == (0, 0)
    assert quiet["avg_resolution_hours"] is None and quiet["pct_closed_within_3_days"] is None
    assert quiet["temp_band"] == "Cold"
    # No weather: the key falls back to the unknown member, the band itself stays null.
    dry = daily.where("service_date = '2026-01-06' and borough_name = 'BRONX' and service_category = 'Unmapped'")
    unknown = spark.range(1).select(facts.unknown_band_key()).first()[0]
    assert (dry.first()["weather_band_key"], dry.first()["temp_band"]) == (unknown, None)
    assert dry.first()["median_resolution_hours"] == 24
    # The spine covers created days only, so the closure on the 20th is not in the mart.
    assert checks.unreconciled(fact, daily).count() == 0
    assert tuple(checks.dropped_closures(fact, daily).first()) == (3, 2, 1)


def test_heat_season_drops_days_without_requests(spark):
    rows = [
        request("1", "2026-01-05T12:00:00", "2026-01-05T14:00:00", complaint_type="HEAT/HOT WATER"),
        request("2", "2026-01-07T12:00:00"),
    ]
    _, fact, daily = build(spark, rows, [(date(2026, 1, 5), 0.0, 0.0, 0.0)])
    heat = reports.heat_season(dimensions.dim_date(spark, SETTINGS), fact, daily)
    assert [tuple(r) for r in heat.collect()] == [
        (date(2026, 1, 5), True, 32.0, 1, 0, 2.0),
        (date(2026, 1, 7), True, None, 0, 1, None),
    ]


def test_snapshot_scope(spark):
    rows = [
        request("open", "2020-01-01T00:00:00"),
        request("recent", "2025-01-01T00:00:00", "2025-12-18T00:00:00"),
        request("past", "2025-01-01T00:00:00", "2025-12-17T23:59:59"),
    ]
    source = facts.snapshot_source(staged(spark, rows), SETTINGS)
    assert rows_of(source, "request_id", "status_changed_at") == [
        ("open", datetime(2020, 1, 1)),
        ("recent", datetime(2025, 12, 18)),
    ]
    assert VALID_FROM not in source.columns


def test_banner_warns_past_four_days(spark):
    _, fact, _ = build(spark, [request("1", "2026-01-27T12:00:00")])
    loads = spark.createDataFrame(
        [("a", 0, datetime(2026, 1, 30)), ("b", 1, datetime(2026, 1, 31))], schemas.LOADS
    )
    freshness = reports.pipeline_freshness(loads, fact, SETTINGS)
    row = freshness.first()
    assert (row["last_load_at"], row["loads_total"], row["requests_total"]) == (datetime(2026, 1, 30), 1, 1)
    banner = reports.freshness_banner(freshness, SETTINGS).first()
    assert (banner["days_behind"], banner["banner_status"]) == (5, "warning")
