"""Type-2 history by the timestamp strategy.

A history has two parts: the open version of each key, and the closed ones. What a run changes follows from
the open ones alone, of which each key has one, so neither part is ever sorted or ranked as a whole, and
repeating a run changes nothing. A key gains at most one version per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskwise.functions.keys import version_id
from deskwise.functions.timing import elapsed_hours
from deskwise.operators.upsert import newest_per_key

# Names of the validity columns.
SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def new_versions(
    current: DataFrame | None,
    source: DataFrame,
    key: str,
    changed_at: str,
    tiebreak: list[Column] | None = None,
) -> DataFrame:
    """Source rows that open a version: unseen keys, and keys that changed since their open one.

    Keys that left the source are not closed.
    """
    source = newest_per_key(source, [key], [F.col(changed_at).desc_nulls_last(), *(tiebreak or [])])
    if current is not None:
        latest = current.select(key, F.col(VALID_FROM).alias("__latest"))
        source = (
            source.join(latest, key, "left")
            .where(F.col("__latest").isNull() | (F.col(changed_at) > F.col("__latest")))
            .drop("__latest")
        )
    return source.withColumns(
        {
            SCD_ID: version_id(F.col(key), F.col(changed_at)),
            UPDATED_AT: F.col(changed_at),
            VALID_FROM: F.col(changed_at),
        }
    )


def closed_by(current: DataFrame, opened: DataFrame, key: str) -> DataFrame:
    """Open versions that one of ``opened`` follows, each closed at the start of that."""
    return current.join(opened.select(key, F.col(VALID_FROM).alias(VALID_TO)), key)


def as_of_join(probes: DataFrame, history: DataFrame, key: str, moment: str) -> DataFrame:
    """Each probe row with the version of its key that was valid at ``moment``, if any."""
    attributes = [c for c in history.columns if c != key]
    h = history.select(F.col(key).alias("__key"), *attributes)
    valid = (F.col(moment) >= F.col(VALID_FROM)) & (
        F.col(VALID_TO).isNull() | (F.col(moment) < F.col(VALID_TO))
    )
    return probes.join(h, (F.col(key) == F.col("__key")) & valid, "left").drop("__key")


def time_in_status(history: DataFrame, keys: list[str]) -> DataFrame:
    """Whole hours spent in each status, over versions that have ended."""
    hours = elapsed_hours(F.col(VALID_FROM), F.col(VALID_TO))
    return (
        history.where(F.col(VALID_TO).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"), F.sum(hours).alias("hours_in_status"))
    )


def stale_open(history: DataFrame, source: DataFrame, key: str, open_status: Column) -> DataFrame:
    """Open versions still showing an open status whose key has left the source's scope: their
    closure aged past the scope between two runs, so no version recorded it."""
    current = history.where(F.col(VALID_TO).isNull() & open_status)
    return current.join(source.select(key), key, "left_anti")
