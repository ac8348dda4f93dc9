"""Generated rows: calendars, literal tables and dense spines.

Dense products are generated by exploding bounded literal or seed-sized lists, never by joining
tables without a key.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1).select()


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    if end <= start:
        return one_row(spark).select(F.lit(start).alias("date_key")).where(F.lit(False))
    days = F.sequence(F.lit(start), F.date_sub(F.lit(end), 1))
    return one_row(spark).select(F.explode(days).alias("date_key"))


def literal_table(spark: SparkSession, schema: str | T.StructType, rows: list[tuple]) -> DataFrame:
    """A table written out in the code.

    Parsed from one literal that Catalyst folds, rather than parallelised from Python, so it knows
    how small the table is and may broadcast it.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return one_row(spark).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema))))


def product(spark: SparkSession, **members: list[str]) -> DataFrame:
    """Every combination of the given lists."""
    rows = one_row(spark)
    for name, values in members.items():
        rows = rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return rows


def per_member(rows: DataFrame, name: str, dimension: DataFrame) -> DataFrame:
    """``rows`` repeated for each distinct ``name`` in a seed-sized dimension.

    The members arrive as one scalar-subquery array, so the plan has a generator where a keyless
    join would be.
    """
    members = dimension.agg(F.collect_set(name)).scalar()
    return rows.withColumn(name, F.explode(members))


def between_scalars(rows: DataFrame, column: Column, low: DataFrame, high: DataFrame) -> DataFrame:
    """Rows whose column lies within two one-row, one-column bounds."""
    return rows.where(column.between(low.scalar(), high.scalar()))
