"""The load ledger and the committed cursors: small append-only tables.

Order of a run: data, then its ledger row, then the cursor. A crash in between re-reads rows, which
the keyed merge absorbs; it never skips any.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.sources import schemas
from deskwise.sources.tables import append_rows, read_table

COMPLETE = 0


def record_load(spark: SparkSession, path: str, load_id: str, at: datetime, status: int = COMPLETE) -> None:
    """One row per load: a run that is repeated finds its row there and adds none."""
    done = read_table(spark, path)
    if done is None or done.where(F.col("load_id") == load_id).isEmpty():
        append_rows(spark.createDataFrame([(load_id, status, at)], schemas.LOADS), path)


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    loads = read_table(spark, path)
    return spark.createDataFrame([], schemas.LOADS) if loads is None else loads


def completed(loads: DataFrame) -> DataFrame:
    return loads.where(F.col("status") == COMPLETE)


def commit_cursor(spark: SparkSession, path: str, name: str, value: datetime, at: datetime) -> None:
    append_rows(spark.createDataFrame([(name, value, at)], schemas.CURSORS), path)


def read_cursors(spark: SparkSession, path: str) -> dict[str, datetime]:
    """Furthest committed value per cursor: one row each, so it may come to the driver."""
    stored = read_table(spark, path)
    if stored is None:
        return {}
    rows = stored.groupBy("cursor_name").agg(F.max("cursor_value").alias("v")).collect()
    return {r["cursor_name"]: r["v"] for r in rows}
