"""Physical plans: what reaches the scan, what is shuffled, and what must never appear."""

import re

import pytest
from compare import TABLES
from pyspark.sql import functions as F

from deskwise import registry
from deskwise.functions.timing import last_moved
from deskwise.operators.upsert import moved_since
from deskwise.plans import facts, staging
from deskwise.settings import instant
from deskwise.sources import adapters, tables


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_schemas(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


LAZY = [
    "fct_requests",
    "fct_daily",
    "fct_orders",
    "orders_daily",
    "agency_performance",
    "heat_season",
    "dim_agency",
    "agency_rollup",
    "incremental_merge",
    "raw_upsert",
    "extract_audit",
    "dq_row_checks",
    "dq_relationships",
    "dq_reconcile",
    "freshness",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_keyless_joins_no_python_no_single_task(spark, sf, name):
    plan = plan_of(registry.QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEval", "MapInPandas"):
        assert bad not in plan
    # One-partition exchanges carry partial aggregates only.
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    for at, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            assert "Aggregate" in lines[at + 1], lines[at + 1]


def test_scans_read_only_needed_columns(spark, sf):
    schemas = read_schemas(plan_of(registry.dim_agency(spark, sf)))
    assert schemas and all("props" not in s and "value" not in s for s in schemas)
    citywide = read_schemas(plan_of(registry.citywide_daily(spark, sf)))
    assert citywide and all("props" not in s for s in citywide)


def test_filters_reach_the_scan(spark, sf, folder):
    feed = registry.Events(spark, sf)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan_of(feed.fact))
    # From a stored raw table, the movement filter arrives too.
    path = f"{folder}/raw"
    tables.overwrite_table(feed.raw, path)
    staged = staging.stg_requests(tables.read_table(spark, path))
    start = instant(adapters.SECOND_EXTRACT)
    moved = registry.landing.since_cursor(staged, "resolution_updated_at", adapters.SECOND_EXTRACT, feed.settings)
    assert "GreaterThanOrEqual(resolution_action_updated_date" in plan_of(moved)
    either = staged.where(last_moved(F.col("resolution_updated_at"), F.col("created_at")) >= start)
    spelled = staged.where(moved_since("resolution_updated_at", "created_at", start))
    assert "Or(GreaterThanOrEqual(resolution_action_updated_date" in plan_of(spelled)
    assert either.count() == spelled.count()
    source = facts.snapshot_source(staged, adapters.SECOND)
    assert "Or(IsNull(closed_date),GreaterThanOrEqual(closed_date" in plan_of(source).replace(" ", "")


def test_month_folders_are_pruned(spark, sf, folder):
    feed = registry.Events(spark, sf)
    tables.write_clustered(feed.fact, f"{folder}/fact", registry.FACT_LAYOUT)
    stored = tables.read_table(spark, f"{folder}/fact")
    plan = plan_of(stored.where(F.col(tables.MONTH) >= "2024-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*month_part", plan)
    assert stored.where(F.col(tables.MONTH) == "2023-12").count() > 0


def test_seed_and_weather_are_broadcast_and_the_fact_is_not_shuffled(spark, sf):
    plan = plan_of(registry.fct_requests(spark, sf))
    main = plan.split("BroadcastExchange")[0]
    assert main.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan


def test_percentiles_combine_before_the_shuffle(spark, sf):
    plan = plan_of(registry.agency_performance(spark, sf))
    assert "partial_count" in plan and "ObjectHashAggregate" not in plan


def test_the_daily_fact_scans_requests_once_for_both_roles(spark, sf):
    feed = registry.Events(spark, sf)
    plan = plan_of(facts.daily_measures(feed.fact))
    assert sum("event_type" in s for s in read_schemas(plan)) == 1


def test_every_benchmark_table_is_known():
    assert {"events", "orders", "lineitem", "customer", "nation", "region"} <= set(TABLES)
