import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskwise.operators.upsert import lookback_filter, lookback_start, merge_rows, moved_since, newest_per_key
from deskwise.settings import Settings, instant
from deskwise.sources import tables
from deskwise.sources.tables import Folder, Layout

DDL = "k string, day timestamp_ntz, v timestamp_ntz, text string"
LAYOUT = Layout(["k"], "day", ["text"])
START = datetime(2026, 1, 1)


def version():
    return F.col("v")


# A key's rows: its version fixes its content, so any order of arrival must end the same.
ROWS = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6)), min_size=1, max_size=12)


def frame(spark, pairs):
    rows = [
        (f"k{k}", START + timedelta(days=20 * ((k + v) % 4)), START + timedelta(hours=v), f"t{v}")
        for k, v in pairs
    ]
    return spark.createDataFrame(rows, DDL)


def expected(pairs):
    newest = {}
    for k, v in pairs:
        newest[k] = max(v, newest.get(k, v))
    return sorted((f"k{k}", f"t{v}") for k, v in newest.items())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_any_order_of_overlapping_batches_gives_one_table(spark, first, second):
    whole = first + second
    for batches in ([first, second], [second, first], [whole, first], [first, second, first]):
        table = None
        for batch in batches:
            table = merge_rows(table, frame(spark, batch), ["k"], version())
        assert rows_of(table, "k", "text") == expected(whole)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_the_stored_table_agrees_and_keys_may_change_month(spark, tmp_path_factory, first, second):
    path = str(tmp_path_factory.mktemp("upsert") / "table")
    for batch in (first, second, first):
        tables.upsert_table(spark, path, frame(spark, batch), LAYOUT, version())
        stored = tables.read_table(spark, path)
        assert stored.groupBy("k").count().where("count > 1").count() == 0
    assert rows_of(stored, "k", "text") == expected(first + second)
    assert stored.where(F.col(tables.MONTH) != F.date_format("day", "yyyy-MM")).count() == 0


def test_a_row_that_is_superseded_does_not_hold_its_partition(spark, folder):
    """k0 leaves January, where an older version of k2 would go."""
    path = f"{folder}/table"
    for batch in ([(0, 0), (2, 4)], [(0, 6), (2, 2)]):
        tables.upsert_table(spark, path, frame(spark, batch), LAYOUT, version())
    assert rows_of(tables.read_table(spark, path), "k", "text") == [("k0", "t6"), ("k2", "t4")]


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(30_000).select(key.alias("k"), F.col("id").alias("v"))
    newest = newest_per_key(rows, ["k"], [F.col("v").desc()])
    assert newest.where("k = 'hot'").first()["v"] == 29_997
    assert newest.count() == 20_001
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def files_of(path):
    """Partition folders with their files, as they are on disk."""
    root = Path(path)
    return {str(f.relative_to(root).parent): {g.name for g in f.parent.glob("*.parquet")} for f in root.rglob("*.parquet")}


def four_months(spark, path, layout=LAYOUT):
    rows = [(f"k{i}", datetime(2026, 1 + i, 5), START, "a") for i in range(4)]
    tables.upsert_table(spark, path, spark.createDataFrame(rows, DDL), layout)
    return rows


def test_untouched_months_are_not_rewritten(spark, folder):
    path = f"{folder}/table"
    four_months(spark, path)
    before = files_of(path)
    change = [("k1", datetime(2026, 3, 1), START, "b")]
    touched = tables.upsert_table(spark, path, spark.createDataFrame(change, DDL), LAYOUT)
    assert touched == ["month_part=2026-02", "month_part=2026-03"]
    after = files_of(path)
    assert after["month_part=2026-01"] == before["month_part=2026-01"]
    assert after["month_part=2026-03"] != before["month_part=2026-03"]
    # k1 was February's only row.
    assert "month_part=2026-02" not in after
    got = rows_of(tables.read_table(spark, path), "k", "text")
    assert got == [("k0", "a"), ("k1", "b"), ("k2", "a"), ("k3", "a")]


BUCKETED = Layout(["k"], "day", ["text"], buckets=4)


def test_a_change_of_one_row_rewrites_one_bucket(spark, folder):
    path = f"{folder}/table"
    rows = [(f"k{i}", datetime(2026, 1 + i % 2, 5), START, "a") for i in range(100)]
    tables.upsert_table(spark, path, spark.createDataFrame(rows, DDL), BUCKETED)
    before = files_of(path)
    assert len(before) == 8
    change = spark.createDataFrame([("k7", datetime(2026, 2, 5), START, "b")], DDL)
    (touched,) = tables.upsert_table(spark, path, change, BUCKETED)
    after = files_of(path)
    assert [p for p in before if before[p] != after[p]] == [touched] and before.keys() == after.keys()
    # Moved to the other month: the same bucket there, and the one it was in.
    moved = spark.createDataFrame([("k7", datetime(2026, 1, 5), START, "c")], DDL)
    both = tables.upsert_table(spark, path, moved, BUCKETED)
    assert len(both) == 2 and len({p.split("/")[1] for p in both}) == 1
    assert [p for p in after if after[p] != files_of(path)[p]] == sorted(both, key=list(after).index)
    got = dict(rows_of(tables.read_table(spark, path), "k", "text"))
    assert len(got) == 100 and got["k7"] == "c" and sum(t == "a" for t in got.values()) == 99


def test_keys_are_looked_for_in_their_buckets_only(spark, folder):
    path = f"{folder}/table"
    four_months(spark, path, BUCKETED)
    stored = tables.read_table(spark, path)
    plan = stored.where(tables._within([tables.MONTH, tables.BUCKET], {("2026-01", 1)}))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(?concat_ws", text) and "DataFilters: []" in text


@pytest.mark.parametrize("write", ["upsert", "overwrite"])
def test_a_run_that_dies_leaves_the_table_as_it_was(spark, folder, monkeypatch, write):
    path = f"{folder}/table"
    tables.overwrite_table(spark.createDataFrame([("k0", datetime(2026, 1, 5), START, "a")], DDL), path, LAYOUT)
    batch = spark.createDataFrame([("k1", datetime(2026, 1, 6), START, "b")], DDL)
    run = {
        "upsert": lambda: tables.upsert_table(spark, path, batch, LAYOUT),
        "overwrite": lambda: tables.overwrite_table(batch, path, LAYOUT),
    }[write]

    def die(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        # The merged rows are not written; the new folder is, but not moved.
        patch.setattr(tables, "_sorted_for", die) if write == "upsert" else patch.setattr(Folder, "take", die)
        with pytest.raises(OSError, match="lost"):
            run()
    assert rows_of(tables.read_table(spark, path), "k") == [("k0",)]
    run()
    want = [("k1",)] if write == "overwrite" else [("k0",), ("k1",)]
    assert rows_of(tables.read_table(spark, path), "k") == want


def test_a_rebuild_that_died_between_two_moves_is_finished(spark, folder):
    path = f"{folder}/table"
    spark.createDataFrame([("new",)], "k string").write.parquet(tables._next(path))
    assert rows_of(tables.read_table(spark, path), "k") == [("new",)]
    assert not Folder(spark, tables._next(path)).exists()


def test_a_narrower_append_keeps_the_columns(spark, folder):
    path = f"{folder}/table"
    tables.append_rows(spark.createDataFrame([("a", 1)], "k string, n int"), path)
    tables.append_rows(spark.createDataFrame([("b",)], "k string"), path)
    assert rows_of(tables.read_table(spark, path), "k", "n") == [("a", 1), ("b", None)]


def test_empty_tables_and_batches(spark, folder):
    path = f"{folder}/table"
    none = spark.createDataFrame([], DDL)
    assert tables.upsert_table(spark, path, none, LAYOUT) == []
    assert tables.read_table(spark, path) is None
    four_months(spark, path)
    before = files_of(path)
    assert tables.upsert_table(spark, path, none, LAYOUT) == [] and files_of(path) == before


def test_columns_are_added_not_lost(spark, folder):
    path = f"{folder}/table"
    old = spark.createDataFrame([("k0", datetime(2026, 1, 5), START, "a")], DDL)
    tables.upsert_table(spark, path, old, LAYOUT)
    new = spark.createDataFrame([("k1", datetime(2026, 2, 5), START, "b", 7)], f"{DDL}, extra int")
    tables.upsert_table(spark, path, new, LAYOUT)
    stored = tables.read_table(spark, path)
    assert rows_of(stored, "k", "text", "extra") == [("k0", "a", None), ("k1", "b", 7)]
    tables.upsert_table(spark, path, old, LAYOUT)
    assert rows_of(tables.read_table(spark, path), "k", "extra") == [("k0", None), ("k1", 7)]


def test_the_catalogue_knows_a_named_table_and_its_new_columns(spark, folder):
    path, name = f"{folder}/layer_x/table", "layer_x.table"
    model = tables.Model("incremental", BUCKETED)
    old = spark.createDataFrame([("k0", datetime(2026, 1, 5), START, "a")], DDL)
    new = spark.createDataFrame([("k1", datetime(2026, 2, 5), START, "b", 7)], f"{DDL}, extra int")
    tables.materialise(model, old, name, path)
    got = tables.materialise(model, new, name, path)
    assert rows_of(got, "k", "extra") == [("k0", None), ("k1", 7)]
    assert rows_of(spark.sql(f"select k, extra, month_part from {name}"), "k", "month_part") == [("k0", "2026-01"), ("k1", "2026-02")]
    assert spark.table(name).columns[-2:] == list(tables.PARTS)
    # The name follows another warehouse of the session, the files of the first stay.
    tables.materialise(tables.Model("table"), old, name, f"{folder}/other/table")
    assert spark.table(name).count() == 1 and tables.read_table(spark, path, name).count() == 2


def moves(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], "id string, updated timestamp_ntz, created timestamp_ntz")


def test_a_future_row_does_not_poison_the_watermark(spark):
    clock = Settings(as_of=datetime(2026, 2, 1), incremental_lookback_days=30)
    target = moves(
        spark,
        ("a", datetime(2026, 1, 31), datetime(2026, 1, 1)),
        ("typo", datetime(2026, 5, 1), datetime(2026, 1, 1)),
    )
    assert lookback_start(target, "updated", "created", clock) == datetime(2026, 1, 1)
    rows = moves(
        spark,
        ("late", datetime(2026, 1, 1), datetime(2025, 6, 1)),
        ("new", None, datetime(2026, 1, 2)),
        ("settled", datetime(2025, 12, 31), datetime(2025, 6, 1)),
    )
    got = lookback_filter(rows, target, "updated", "created", clock)
    assert rows_of(got, "id") == [("late",), ("new",)]


def test_an_empty_target_means_a_full_load(spark):
    clock = Settings(as_of=datetime(2026, 2, 1))
    rows = moves(spark, ("a", None, datetime(2020, 1, 1)))
    empty = rows.where("false")
    assert lookback_start(empty, "updated", "created", clock) is None
    assert lookback_filter(rows, empty, "updated", "created", clock).count() == 1
    assert lookback_filter(rows, None, "updated", "created", clock).count() == 1


def test_moved_since_equals_the_coalesced_form(spark):
    days = [None, datetime(2026, 1, 1), datetime(2026, 1, 2), datetime(2026, 1, 3)]
    rows = moves(spark, *[(f"{i}{j}", u, c) for i, u in enumerate(days) for j, c in enumerate(days)])
    start = instant(datetime(2026, 1, 2))
    coalesced = rows.where(F.coalesce("updated", "created") >= start)
    assert rows_of(rows.where(moved_since("updated", "created", start)), "id") == rows_of(coalesced, "id")


def test_a_null_version_never_blocks_a_correction(spark):
    ddl = "k string, v timestamp_ntz, text string"
    typo = spark.createDataFrame([("a", None, "typo")], ddl)
    fixed = spark.createDataFrame([("a", START, "fixed")], ddl)
    assert merge_rows(typo, fixed, ["k"], version()).first()["text"] == "fixed"
    assert merge_rows(fixed, typo, ["k"], version()).first()["text"] == "typo"


def test_shuffles_widen_with_the_stored_bytes(spark, folder, monkeypatch):
    spark.range(1000).write.parquet(f"{folder}/t")
    paths = [f"{folder}/t", f"{folder}/absent"]
    assert tables.shuffle_width(spark, paths) == 4
    monkeypatch.setattr(tables, "PARTITION_BYTES", 100)
    assert tables.shuffle_width(spark, paths) == -(-Folder(spark, paths[0]).size() // 100) > 7
    assert spark.conf.get(tables.WIDTH, None) is None
