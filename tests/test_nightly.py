"""Whole nightly runs over landed files."""

import json
from datetime import datetime, timedelta

import pytest
from helpers import request, rows_of, seed
from pyspark.sql import functions as F

from deskwise.operators.history import VALID_TO
from deskwise.plans import facts
from deskwise.plans import nightly as job_module
from deskwise.plans.nightly import CHECKS, MARTS, RAW, REPORTS, ChecksFailed, Job, run_nightly
from deskwise.settings import RunPlan, Settings
from deskwise.sources import landing, ledger, schemas
from deskwise.sources.tables import Warehouse

BOTH = RunPlan(frozenset({"requests", "weather"}), False)
FIRST, SECOND = datetime(2026, 1, 20), datetime(2026, 1, 21)


def clock(as_of):
    return Settings(as_of=as_of, incremental_lookback_days=5, weather_lookback_days=14)


def land(folder, name, rows):
    with open(f"{folder}/{name}.json", "w") as out:
        for r in rows:
            out.write(json.dumps({f: r.get(f) for f in schemas.REQUEST_FIELDS} | {"latitude": "40.7"}) + "\n")
    return f"{folder}/{name}.json"


def payloads(spark, as_of, warmer=0.0):
    days = [(as_of - timedelta(days=d)).date().isoformat() for d in range(1, 10)]
    arrays = {v: [float(i) + warmer for i in range(len(days))] for v in schemas.WEATHER_VARIABLES}
    return spark.createDataFrame([(json.dumps({"daily": {"time": days, **arrays}}),)], "body string")


def nightly(spark, root, as_of, files, plan=BOTH, warmer=0.0):
    job = Job(spark, Warehouse(root), clock(as_of))
    return job, run_nightly(job, plan, files, payloads(spark, as_of, warmer), "body", seed(spark))


NIGHT_1 = [
    request("long", "2025-11-01T12:00:00", updated="2026-01-01T00:00:00"),
    request("open", "2026-01-18T12:00:00"),
    request("closes", "2026-01-18T12:00:00", complaint_type="HEAT/HOT WATER"),
    request("old", "2020-01-01T12:00:00", "2026-01-18T12:00:00"),
    # One row typed three months ahead.
    request("typo", "2026-01-17T12:00:00", "2026-01-18T12:00:00", "2026-04-18T12:00:00"),
]
NIGHT_2 = [
    request("closes", "2026-01-18T12:00:00", "2026-01-20T13:00:00", complaint_type="HEAT/HOT WATER"),
    request("long", "2025-11-01T12:00:00", "2026-01-20T12:00:00"),
    request("new", "2026-01-20T12:00:00"),
]


def test_two_nights(spark, folder):
    root = f"{folder}/wh"
    first = land(folder, "one", NIGHT_1)
    job, models = nightly(spark, root, FIRST, first)
    fact = rows_of(models["fct_requests"], "request_id", "is_closed")
    assert fact == [("closes", False), ("long", False), ("open", False), ("typo", True)]
    outcome = {r["check_name"]: (r["failures"], r["outcome"]) for r in models["checks"].collect()}
    assert outcome["fct_daily.reconciles_to_requests"] == (0, "pass")
    assert outcome["fct_requests.types_are_mapped"] == (1, "warn")
    assert outcome["fct_requests.no_future_milestones"] == (1, "pass")
    assert {n for n, (_, o) in outcome.items() if o == "error"} == set()
    assert len(outcome) == 148
    # The typed-ahead date did not move the cursor past the clock.
    cursors = ledger.read_cursors(spark, job.path(RAW, "cursors"))
    assert cursors == {landing.CREATED: datetime(2026, 1, 18, 12), landing.UPDATED: datetime(2026, 1, 18, 12)}

    second = land(folder, "two", NIGHT_2)
    job, models = nightly(spark, root, SECOND, [first, second], warmer=0.5)
    fact = rows_of(models["fct_requests"], "request_id", "is_closed", "reportable_resolution_hours")
    assert fact == [
        ("closes", True, 49),
        ("long", True, 1920),
        ("new", False, None),
        ("open", False, None),
        ("typo", True, 24),
    ]
    status = models["snp_request_status"]
    assert rows_of(status.where("request_id = 'closes'"), "status", VALID_TO) == [
        ("Closed", None),
        ("Open", datetime(2026, 1, 20, 13)),
    ]
    outcome = {r["check_name"]: r["outcome"] for r in models["checks"].collect()}
    assert "error" not in outcome.values()
    # Nine days re-read, the earliest one landed the night before.
    weather = job.read(RAW, "weather_daily")
    assert weather.count() == 10
    assert ledger.completed(ledger.read_loads(spark, job.path(RAW, "loads"))).count() == 4
    assert models["pipeline_freshness"].first()["requests_total"] == 5
    assert models["agency_performance"].agg(F.sum("requests_total")).first()[0] == 5

    # Running the same night again changes nothing.
    names = ("fct_requests", "fct_daily", "snp_request_status")
    before = {n: rows_of(models[n], *sorted(models[n].columns)) for n in names}
    again = nightly(spark, root, SECOND, [first, second], warmer=0.5)[1]
    assert before == {n: rows_of(again[n], *sorted(again[n].columns)) for n in names}
    outcome = {r["check_name"]: r["outcome"] for r in again["checks"].collect()}
    assert len(outcome) == 148 and "error" not in outcome.values()


def test_incremental_equals_full_within_the_window(spark, folder):
    first, second = land(folder, "one", NIGHT_1), land(folder, "two", NIGHT_2)
    step = f"{folder}/step"
    nightly(spark, step, FIRST, first)
    merged = nightly(spark, step, SECOND, [first, second])[1]
    whole = nightly(spark, f"{folder}/whole", SECOND, [first, second])[1]
    columns = [c for c in facts.FACT_COLUMNS if c != "dlt_load_id"]
    assert rows_of(merged["fct_requests"], *columns) == rows_of(whole["fct_requests"], *columns)


def test_a_failing_load_commits_nothing(spark, folder, monkeypatch):
    root = f"{folder}/wh"
    files = land(folder, "one", NIGHT_1)

    def fail(*args, **kwargs):
        raise RuntimeError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(job_module, "materialise", fail)
        with pytest.raises(RuntimeError, match="disk"):
            nightly(spark, root, FIRST, files)
    job = Job(spark, Warehouse(root), clock(FIRST))
    assert ledger.read_cursors(spark, job.path(RAW, "cursors")) == {}
    assert ledger.read_loads(spark, job.path(RAW, "loads")).count() == 0


def test_only_the_selected_feed_is_landed(spark, folder):
    job = Job(spark, Warehouse(f"{folder}/wh"), clock(FIRST))
    job.land_weather(payloads(spark, FIRST), "body", "w")
    assert job.read(RAW, "service_requests") is None
    assert job.read(RAW, "weather_daily").count() == 9
    assert job.read(MARTS, "fct_requests") is None


def test_an_error_stops_the_reports_and_is_stored(spark, folder, monkeypatch):
    root = f"{folder}/wh"
    files = land(folder, "one", NIGHT_1)
    monkeypatch.setattr(job_module.checks, "MAX_UNMAPPED_TYPES", 0)
    with pytest.raises(ChecksFailed) as raised:
        nightly(spark, root, FIRST, files)
    job = Job(spark, Warehouse(root), clock(FIRST))
    stored = {r["check_name"]: r["outcome"] for r in job.read(CHECKS, "results").collect()}
    assert raised.value.names == [n for n, o in stored.items() if o == "error"] == ["fct_requests.types_are_mapped"]
    assert job.read(REPORTS, "agency_performance") is None


def test_stale_sources_are_stored_and_stop_nothing(spark, folder):
    files = land(folder, "one", NIGHT_1)
    late = FIRST + timedelta(days=30)
    job, models = nightly(spark, f"{folder}/wh", late, files)
    outcome = {r["source_name"]: r["outcome"] for r in models["freshness"].collect()}
    assert outcome == {"service_requests": "error", "weather_daily": "pass", "loads": "pass"}
    assert job.read(REPORTS, "agency_performance") is not None
