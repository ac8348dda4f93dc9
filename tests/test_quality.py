from datetime import date, datetime, timedelta

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from deskwise.operators import quality as q
from deskwise.plans import checks
from deskwise.settings import Settings

CLOCK = Settings(as_of=datetime(2026, 2, 1))


def findings(frame):
    return {r["check_name"]: r["failures"] for r in frame.collect()}


def test_row_checks_count_failing_rows_in_one_pass(spark):
    rows = spark.createDataFrame(
        [(None, "a", 5, True), (1, "z", 11, False), (2, None, None, None), (3, "b", -1, True)],
        "k int, v string, n int, f boolean",
    )
    named = {
        "missing": q.is_missing("k"),
        "missing_where": q.is_missing("k", F.col("f")),
        "accepted": q.not_accepted("v", ["a", "b"]),
        "range": q.out_of_range("n", 0, 10),
        "low_only": q.out_of_range("n", 0),
        "conditional": q.out_of_range("n", 0, 10, F.col("f")),
    }
    frame = q.row_findings(rows, named)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert findings(frame) == {
        "missing": 1,
        "missing_where": 1,
        "accepted": 1,
        "range": 2,
        "low_only": 1,
        "conditional": 1,
    }


def test_uniqueness_ignores_lone_nulls_but_not_null_combinations(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, "b", None), (None, "c", 1), (None, "c", 1)], "k int, a string, b int"
    )
    found = q.unique_findings(rows, {"k": ["k"], "ab": ["a", "b"], "b": ["b"], "kab": ["k", "a", "b"]})
    assert findings(found) == {"k": 1, "ab": 2, "b": 1, "kab": 2}
    assert findings(q.unique_findings(rows.where("k = 2"), {"k": ["k"]})) == {}
    assert rows_of(q.duplicates(rows, ["k"]), "k", "n") == [(1, 2)]


def test_orphans_count_child_rows_and_pass_nulls(spark):
    child = spark.createDataFrame([("x", 1), ("x", 2), ("y", None), (None, 3)], "p string, d int")
    parents = spark.createDataFrame([("y",)], "p string")
    numbers = spark.createDataFrame([(1,), (2,), (3,)], "d int")
    found = q.orphan_findings(child, {"p": ("p", parents, "p"), "d": ("d", numbers, "d")})
    assert findings(found) == {"p": 2}
    assert findings(q.with_all(found, ["p", "d"])) == {"p": 2, "d": 0}


def test_outcomes_follow_the_limits(spark):
    found = spark.createDataFrame([("a", 1), ("b", 1), ("c", 11), ("d", 2), ("e", 10001)], "check_name string, failures bigint")
    limits = {"b": q.WARN_ON_ANY, "c": q.Limits(10, None), "d": q.Limits(10, None), "e": q.Limits(0, 10000)}
    got = {r["check_name"]: r["outcome"] for r in q.judged(found, [*"abcdef"], limits).collect()}
    assert got == {"a": "error", "b": "warn", "c": "warn", "d": "pass", "e": "error", "f": "pass"}


@pytest.mark.parametrize(
    ("days", "outcome"), [(1, "pass"), (3, "pass"), (3.1, "warn"), (7, "warn"), (7.1, "error"), (None, "error")]
)
def test_freshness_by_age(spark, days, outcome):
    moment = None if days is None else CLOCK.as_of - timedelta(days=days)
    rows = spark.createDataFrame([(moment,)], "created_date timestamp_ntz")
    assert checks.freshness({"service_requests": rows}, CLOCK).first()["outcome"] == outcome


def test_freshness_of_a_date_column(spark):
    rows = spark.createDataFrame([(date(2026, 1, 23),)], "observed_on date")
    got = checks.freshness({"weather_daily": rows}, CLOCK).first()
    assert (got["max_loaded_at"], got["outcome"]) == (datetime(2026, 1, 23), "warn")


def test_the_suite_is_complete():
    assert sum(c.count for c in checks.DECLARED.values()) == 141
    marts = [t for t in checks.DECLARED if t.startswith(("dim_", "fct_", "snp_"))]
    assert sum(checks.DECLARED[t].count for t in marts) == 100


def test_cross_column_rules_catch_planted_rows(spark):
    ddl = "is_closed boolean, closed_at timestamp_ntz, resolution_hours bigint"
    at = datetime(2026, 1, 1)
    rows = spark.createDataFrame(
        [(True, at, 1), (False, None, None), (True, None, 1), (True, at, None), (False, at, None), (False, None, 1)], ddl
    )
    assert rows.where(checks.closure_is_inconsistent()).count() == 4
    counters = spark.createDataFrame(
        [(1, 2, 3, 4), (3, 2, 3, 4), (1, 4, 3, 4), (1, 2, 5, 4)],
        "closed_within_1_day int, closed_within_3_days int, closures_measured int, requests_closed int",
    )
    assert counters.where(checks.counters_do_not_nest()).count() == 3
    days = spark.createDataFrame(
        [(date(2025, 5, 31), True), (date(2025, 6, 1), False), (date(2025, 9, 30), True), (date(2025, 10, 1), False)],
        "date_key date, is_heat_season boolean",
    )
    assert rows_of(days.where(checks.heat_season_is_wrong()), "date_key") == [(date(2025, 10, 1),), (date(2025, 9, 30),)]
