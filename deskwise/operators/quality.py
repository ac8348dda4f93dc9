"""Data-quality checks.

Every check counts failing rows. Row-level checks on one table are terms of a single aggregate, so
a table of any size is scanned once for all of them; foreign keys share one more pass; only
uniqueness needs a shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import astuple, dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskwise.operators.spine import literal_table
from deskwise.settings import Settings

# Outcomes and severities.
PASS, WARN, ERROR = "pass", "warn", "error"
# A check that was not made, as what it checks was not built.
SKIPPED = "skipped"

@dataclass(frozen=True)
class Limits:
    """A check warns or errors when its failures exceed the limit; None never triggers."""

    warn_above: int | None = None
    error_above: int | None = 0


ERROR_ON_ANY = Limits()
WARN_ON_ANY = Limits(warn_above=0, error_above=None)


# Predicates that hold for failing rows


def is_missing(column: str, where: Column | None = None) -> Column:
    failing = F.col(column).isNull()
    return failing if where is None else where & failing


def not_accepted(column: str, values: list[str]) -> Column:
    """Null passes."""
    return ~F.col(column).isin(values)


def out_of_range(column: str, low=None, high=None, where: Column | None = None) -> Column:
    """Null passes; so does a row the condition leaves out."""
    failing = F.lit(False)
    if low is not None:
        failing = failing | (F.col(column) < low)
    if high is not None:
        failing = failing | (F.col(column) > high)
    return failing if where is None else where & failing


# Passes


def row_findings(rows: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Failing rows per named predicate: one aggregate over one scan."""
    names = list(predicates)
    counted = rows.agg(*[F.count_if(predicates[n]).alias(f"c{i}") for i, n in enumerate(names)])
    entries = [
        F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures"))
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*entries)))


class RowTerms:
    """Row checks that are counted while the rows pass by on their way to a write.

    ``attach`` adds the counts to a plan; the first action that runs it, one write, brings them along, so
    the rows are not scanned again for their checks. ``findings`` waits for that action.
    """

    def __init__(self, predicates: Mapping[str, Column]):
        self.names = list(predicates)
        self.terms = [F.count_if(predicates[n]).alias(f"c{i}") for i, n in enumerate(self.names)]
        self.observation = Observation()

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.observation, *self.terms) if self.terms else rows

    def findings(self, spark: SparkSession) -> DataFrame:
        counts = self.observation.get if self.terms else {}
        rows = [(n, counts[f"c{i}"]) for i, n in enumerate(self.names)]
        return literal_table(spark, "check_name string, failures bigint", rows)


def duplicates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Values of one column, or combinations of several, that occur more than once. A lone null is
    not a value; within a combination it is."""
    scope = rows.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else rows
    return scope.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_findings(rows: DataFrame, checks: Mapping[str, list[str]]) -> DataFrame:
    """Repeated values per named check; checks without any have no row.

    All checks of a table are grouping sets of one aggregate, which counts map-side: one scan and
    one shuffle, and a value that repeats a billion times leaves each task as one row.
    """
    columns = list(dict.fromkeys(c for cs in checks.values() for c in cs))
    counted = (
        rows.groupingSets([[F.col(c) for c in cs] for cs in checks.values()], *columns)
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
        .where(F.col("n") > 1)
    )
    name = F.lit(None).cast("string")
    for check, cs in checks.items():
        # A grouping id has a one-bit for each column that is not in the set.
        gid = int("".join("0" if c in cs else "1" for c in columns), 2)
        counts = F.col("gid") == gid
        if len(cs) == 1:
            counts = counts & F.col(cs[0]).isNotNull()
        name = F.when(counts, check).otherwise(name)
    return (
        counted.select(name.alias("check_name"))
        .where(F.col("check_name").isNotNull())
        .groupBy("check_name")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def orphan_findings(
    rows: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """Child rows whose key is in no parent row, per named reference (column, parent, field);
    references without any have no row.

    All references of a table share one scan: each row yields one (check, key) entry per reference,
    which are counted map-side down to the distinct keys before anything is shuffled or joined.
    """
    entries = [
        F.struct(F.lit(n).alias("check_name"), F.col(c).cast("string").alias("key"))
        for n, (c, _, _) in references.items()
    ]
    used = (
        rows.select(F.inline(F.array(*entries)))
        .where(F.col("key").isNotNull())
        .groupBy("check_name", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(n).alias("check_name"), F.col(field).cast("string").alias("key"))
            for n, (_, parent, field) in references.items()
        ],
    )
    orphans = used.join(known, ["check_name", "key"], "left_anti")
    return orphans.groupBy("check_name").agg(F.sum("n").alias("failures"))


def findings_of(failing: DataFrame, name: str) -> DataFrame:
    """The finding of a check written as a query for failing rows."""
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check_name"), "failures"
    )


def with_all(findings: DataFrame, names: list[str]) -> DataFrame:
    """One row per check: those without a finding have no failures."""
    every = literal_table(findings.sparkSession, "check_name string", [(n,) for n in names])
    return every.join(findings, "check_name", "left").select(
        "check_name", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def judged(findings: DataFrame, names: list[str], limits: Mapping[str, Limits]) -> DataFrame:
    """Every check with its failures and outcome. Without limits of its own, any failure errors."""
    rows = [(n, *astuple(limits.get(n, ERROR_ON_ANY))) for n in names]
    every = literal_table(
        findings.sparkSession, "check_name string, warn_above bigint, error_above bigint", rows
    )
    outcome = (
        F.when(F.col("failures") > F.col("error_above"), ERROR)
        .when(F.col("failures") > F.col("warn_above"), WARN)
        .otherwise(PASS)
    )
    return (
        every.join(findings, "check_name", "left")
        .withColumn("failures", F.coalesce("failures", F.lit(0)))
        .select("check_name", "failures", outcome.alias("outcome"))
    )


# Source freshness


@dataclass(frozen=True)
class Freshness:
    warn_after: timedelta
    error_after: timedelta


def source_freshness(
    spark: SparkSession, sources: Mapping[str, tuple[DataFrame, Column, Freshness]], settings: Settings
) -> DataFrame:
    """Age of each source's newest row against its limits; a source without rows is an error."""
    parts = []
    for name, (rows, moment, limits) in sources.items():
        newest = rows.agg(F.max(moment).cast("timestamp_ntz").alias("max_loaded_at"))
        age = settings.now - F.col("max_loaded_at")
        outcome = (
            F.when(F.col("max_loaded_at").isNull() | (age > F.lit(limits.error_after)), ERROR)
            .when(age > F.lit(limits.warn_after), WARN)
            .otherwise(PASS)
        )
        parts.append(
            newest.select(F.lit(name).alias("source_name"), "max_loaded_at", outcome.alias("outcome"))
        )
    return reduce(DataFrame.unionByName, parts)
