"""Keyed merge over plain Parquet tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskwise.functions.timing import last_moved
from deskwise.settings import Settings, instant

RANK = "__rank"
STAMP = "__stamp"


def newest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first under ``order``.

    ``row_number() = 1`` gets a group limit ahead of the shuffle, so however often a key repeats,
    each task sends at most one row of it.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def merge_rows(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    version: Column | None = None,
    tiebreak: list[Column] | None = None,
) -> DataFrame:
    """``target`` with the batch's rows inserted, or replacing the rows that share their key.

    With ``version``, the batch may repeat keys and a key's newest row survives, whichever side it
    is on; see ``replace_rows``. Without it the batch must hold one row per key, and wins.
    """
    if version is not None:
        batch = newest_per_key(batch, keys, [version.desc_nulls_last(), *(tiebreak or [])])
    return batch if target is None else replace_rows(target, batch, keys, version)


def replace_rows(
    target: DataFrame, batch: DataFrame, keys: list[str], version: Column | None = None
) -> DataFrame:
    """Merge a batch of one row per key. A stored row with a newer version stays; an equal version
    is replaced, so re-reading a batch changes nothing; a null version cannot be compared, so the
    batch wins. Columns missing on one side are filled with nulls.

    Only the target's keys meet the batch before rows are kept: a small batch is broadcast, and the
    target is then filtered in place without being shuffled.
    """
    if version is not None:
        batch = not_superseded(target, batch, keys, version)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def not_superseded(
    target: DataFrame, batch: DataFrame, keys: list[str], version: Column
) -> DataFrame:
    """Batch rows whose key has no newer version in the target.

    The stored versions of the batch's keys are found by a semi join on the key columns alone, which
    lets Spark broadcast a small batch, or filter the target's scan by a Bloom filter of its keys,
    instead of shuffling whole target rows.
    """
    incoming = batch.select(*keys, version.alias(STAMP)).alias("b")
    stored = target.select(*keys, version.alias(STAMP)).alias("t")
    same_key = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    newer = F.col(f"t.{STAMP}") > F.col(f"b.{STAMP}")
    superseded = stored.join(incoming, [*same_key, newer], "left_semi").select(*keys)
    return batch.join(superseded, keys, "left_anti")


def moved_since(updated: str, created: str, start: Column) -> Column:
    """``coalesce(updated, created) >= start``, spelled so that Parquet can skip row groups by it."""
    return (F.col(updated) >= start) | (F.col(updated).isNull() & (F.col(created) >= start))


def lookback_start(
    target: DataFrame, updated: str, created: str, settings: Settings
) -> datetime | None:
    """Where an incremental run starts reading: the newest movement in the target less the lookback.

    Movements later than ``as_of`` are ignored. One mistyped future date would otherwise push the
    watermark past every real update, and the table would silently stop growing. None (an empty
    target) means everything is to be read.
    """
    return watermark(target, updated, created, settings).first()[0]


def lookback_filter(
    rows: DataFrame, target: DataFrame | None, updated: str, created: str, settings: Settings
) -> DataFrame:
    """Rows that moved within the lookback of the target's watermark; all rows without a watermark.

    The watermark is a scalar subquery here, so the whole step stays one lazy plan.
    """
    if target is None:
        return rows
    start = watermark(target, updated, created, settings).scalar()
    return rows.where(moved_since(updated, created, F.coalesce(start, instant(datetime.min))))


def watermark(target: DataFrame, updated: str, created: str, settings: Settings) -> DataFrame:
    """One row, with the newest movement that is not later than the clock, less the lookback."""
    moved = last_moved(F.col(updated), F.col(created))
    lookback = F.make_dt_interval(F.lit(settings.incremental_lookback_days))
    return target.where(moved <= settings.now).agg((F.max(moved) - lookback).alias("start"))
