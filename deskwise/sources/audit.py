"""Completeness of a chunked extract.

A walk lands numbered chunks whose cursor ranges must join up: each chunk starts no later than the
previous one ended, and each but the last moves the cursor on. Chunks are compared by an equi-join
on the chunk number, not by one window over the whole walk, so a walk of millions of chunks stays
distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["walk", "chunk_no"]


def chunk_summary(rows: DataFrame, cursor: str) -> DataFrame:
    return rows.groupBy(*KEYS).agg(
        F.min(cursor).alias("first_cursor"),
        F.max(cursor).alias("last_cursor"),
        F.count(F.lit(1)).alias("rows"),
    )


def with_previous(chunks: DataFrame) -> DataFrame:
    """Each chunk beside the end of the chunk numbered one before it."""
    shifted = chunks.select(
        "walk",
        (F.col("chunk_no") + 1).alias("chunk_no"),
        F.col("last_cursor").alias("previous_last"),
    )
    return chunks.join(shifted, KEYS, "left")


def chunk_findings(rows: DataFrame, cursor: str) -> DataFrame:
    """``summary_findings`` of the chunks that the rows (walk, chunk_no, cursor) are from."""
    return summary_findings(chunk_summary(rows, cursor))


def continued(chunks: DataFrame, before: DataFrame | None) -> DataFrame:
    """Chunks of this run behind the last one that earlier runs landed of the same walk."""
    if before is None:
        return chunks
    columns = [c for c in before.columns if c != "walk"]
    last = before.groupBy("walk").agg(F.max_by(F.struct(*columns), "chunk_no").alias("last")).select("walk", "last.*")
    walks = chunks.select("walk").distinct()
    earlier = last.join(walks, "walk", "left_semi").join(chunks, KEYS, "left_anti")
    return chunks.unionByName(earlier.select(*chunks.columns))


def summary_findings(chunks: DataFrame) -> DataFrame:
    """Chunks that break the walk: ``missing_before`` (no previous chunk landed), ``gap`` (starts
    after the previous end), ``stalled`` (ends where the previous ended, with data beyond it)."""
    ends = chunks.groupBy("walk").agg(
        F.min("chunk_no").alias("first_no"), F.max("last_cursor").alias("walk_end")
    )
    # Only chunk summaries are joined here, and the walks' ends are far fewer still: AQE turns this
    # into a broadcast once it has measured them, and splits a long walk if it does not.
    compared = with_previous(chunks).join(ends, "walk")
    # An inclusive boundary re-reads the previous end, so the last chunk of a finished walk may sit
    # exactly on it. Only a chunk that fails to advance while rows lie beyond is a stall.
    stalled = (F.col("last_cursor") <= F.col("previous_last")) & (
        F.col("last_cursor") < F.col("walk_end")
    )
    finding = (
        F.when((F.col("chunk_no") > F.col("first_no")) & F.col("previous_last").isNull(), "missing_before")
        .when(F.col("first_cursor") > F.col("previous_last"), "gap")
        .when(stalled, "stalled")
    )
    return (
        compared.withColumn("finding", finding)
        .where(F.col("finding").isNotNull())
        .select(*KEYS, "finding", "first_cursor", "last_cursor", "previous_last", "rows")
    )


def never_landed(manifest: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keys the manifest lists that no landed chunk holds."""
    return manifest.join(rows.select(key), key, "left_anti")


def edge_findings(rows: DataFrame, walks: DataFrame) -> DataFrame:
    """Walks that lack their first or last chunk, which no comparison of landed neighbours can tell.

    ``walks`` lists walk, first_no and last_no as the extract committed them. A walk of which nothing
    landed has both findings, with a null landed_no.
    """
    landed = rows.groupBy("walk").agg(F.min("chunk_no").alias("low"), F.max("chunk_no").alias("high"))
    ends = F.array(
        F.struct(F.lit("missing_first").alias("finding"), F.col("first_no").alias("expected_no"),
                 F.col("low").alias("landed_no")),
        F.struct(F.lit("missing_last").alias("finding"), F.col("last_no").alias("expected_no"),
                 F.col("high").alias("landed_no")),
    )
    return (
        walks.join(landed, "walk", "left")
        .select("walk", F.inline(ends))
        .where(~F.col("expected_no").eqNullSafe(F.col("landed_no")))
    )
