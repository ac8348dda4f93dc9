from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskwise.operators import history
from deskwise.operators.history import SCD_ID, VALID_FROM, VALID_TO
from deskwise.operators.upsert import merge_rows
from deskwise.sources import tables

DDL = "id string, status string, changed timestamp_ntz"
START = datetime(2026, 1, 1)
# Runs of (key, hour of change); a key may be missing from a run, or repeat inside it.
RUNS = st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), max_size=5), min_size=1, max_size=4)


def source(spark, pairs):
    rows = [(f"r{k}", f"s{h}", START + timedelta(hours=h)) for k, h in pairs]
    return spark.createDataFrame(rows, DDL)


def apply(spark, state, pairs):
    """Open and closed versions after a run."""
    current, closed = state or (None, None)
    opened = history.new_versions(current, source(spark, pairs), "id", "changed")
    if current is None:
        return opened, history.closed_by(opened, opened.where("false"), "id")
    ended = history.closed_by(current, opened, "id")
    return merge_rows(current, opened, ["id"]), closed.unionByName(ended)


def whole_of(state):
    current, closed = state
    return current.withColumn(VALID_TO, F.lit(None).cast("timestamp_ntz")).unionByName(closed)


def expected(runs):
    """Versions (key, hour): a run opens one for a key seen at a later hour than its last."""
    seen = {}
    for run in runs:
        for k in {k for k, _ in run}:
            hour = max(h for j, h in run if j == k)
            if not seen.get(k) or hour > seen[k][-1]:
                seen.setdefault(k, []).append(hour)
    return sorted((f"r{k}", f"s{h}") for k, hours in seen.items() for h in hours)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(RUNS)
def test_versions_follow_the_changes_and_tile_time(spark, runs):
    state = None
    for run in runs:
        state = apply(spark, state, run)
    whole = whole_of(state)
    assert rows_of(whole, "id", "status") == expected(runs)
    # A repeated run changes nothing.
    assert rows_of(whole_of(apply(spark, state, runs[-1])), SCD_ID, VALID_TO) == rows_of(whole, SCD_ID, VALID_TO)

    whole = whole.collect()
    assert len({r[SCD_ID] for r in whole}) == len(whole)
    for key in {r["id"] for r in whole}:
        own = sorted((r for r in whole if r["id"] == key), key=lambda r: r[VALID_FROM])
        assert [r[VALID_TO] for r in own] == [*[r[VALID_FROM] for r in own[1:]], None]


HOW = tables.Snapshot("id", "changed", buckets=4)


def test_the_stored_history_agrees_and_survives_a_lost_run(spark, folder, monkeypatch):
    path, state = f"{folder}/history", None
    runs = [[(0, 1), (1, 1), (2, 1)], [(0, 3), (3, 2)], [(0, 4), (1, 5)]]
    for run in runs:
        state = apply(spark, state, run)
        real, calls = tables.upsert_table, []

        def die_at_current(session, where, *rest, real=real, calls=calls):
            calls.append(where)
            if where.endswith("current"):
                raise OSError("lost")
            return real(session, where, *rest)

        with monkeypatch.context() as patch:
            patch.setattr(tables, "upsert_table", die_at_current)
            with pytest.raises(OSError, match="lost"):
                tables.snapshot_table(source(spark, run), path, HOW)
        for _ in range(2):
            tables.snapshot_table(source(spark, run), path, HOW)
        got = tables.read_history(spark, path)
        assert rows_of(got, "id", "status", VALID_TO) == rows_of(whole_of(state), "id", "status", VALID_TO)
    assert rows_of(tables.read_current(spark, path), "id", "status") == rows_of(state[0], "id", "status")


def test_reading_the_open_versions_ranks_and_joins_nothing(spark, folder):
    path = f"{folder}/history"
    for run in ([(0, 1), (1, 1)], [(0, 3)]):
        tables.snapshot_table(source(spark, run), path, HOW)
    plan = tables.read_current(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Window", "Exchange", "Sort", "Join", "Aggregate"))
    plan = tables.read_history(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Window", "Exchange", "Sort", "Join", "Aggregate"))


def test_a_run_rewrites_the_buckets_of_what_changed(spark, folder):
    path = f"{folder}/history"
    tables.snapshot_table(source(spark, [(k, 1) for k in range(40)]), path, HOW)
    buckets = sorted(Path(path, "current").glob("bucket_part=*"))
    before = [{f.name for f in b.glob("*.parquet")} for b in buckets]
    tables.snapshot_table(source(spark, [(k, 1 + (k == 7)) for k in range(40)]), path, HOW)
    after = [{f.name for f in b.glob("*.parquet")} for b in buckets]
    assert len(buckets) == 4 and sum(x != y for x, y in zip(before, after, strict=True)) == 1


def test_leaving_the_source_does_not_close_a_version(spark):
    whole = whole_of(apply(spark, apply(spark, None, [(0, 1), (1, 1)]), [(1, 3)]))
    assert rows_of(whole.where(F.col(VALID_TO).isNull()), "id", "status") == [("r0", "s1"), ("r1", "s3")]
    stale = history.stale_open(whole, source(spark, [(1, 3)]), "id", F.col("status") == "s1")
    assert rows_of(stale, "id") == [("r0",)]


def test_point_in_time_and_time_in_status(spark):
    whole = whole_of(apply(spark, apply(spark, None, [(0, 1)]), [(0, 4)]))
    probes = spark.createDataFrame(
        [("r0", START + timedelta(hours=h)) for h in (0, 1, 3, 4, 9)] + [("other", START)],
        "id string, at timestamp_ntz",
    )
    got = {(r["id"], r["at"].hour): r["status"] for r in history.as_of_join(probes, whole, "id", "at").collect()}
    assert got == {("r0", 0): None, ("r0", 1): "s1", ("r0", 3): "s1", ("r0", 4): "s4", ("r0", 9): "s4", ("other", 0): None}
    assert rows_of(history.time_in_status(whole, ["status"]), "status", "versions", "hours_in_status") == [("s1", 1, 3)]
