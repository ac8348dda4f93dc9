"""Proportional stratified interleaving, in DataFrame operations alone.

Rows of a source are put in a seeded random order; the row of rank r of n gets the fraction
(r - 1/2) / n. Sorted by fraction, the sources are interleaved in proportion, so that any contiguous
cut holds the mixture of the whole. Both ranks are taken without putting a source, or the table, in
one task: rows are dealt to cells by a prefix of their sort key, cells are counted, the counts are
summed up cell by cell, and a row is only ranked within its cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskwise.llm.common import text_of

# Rows per cell, on average.
CELL_ROWS = 4096
# Repeats of a row that are listed at a time.
LISTED = 1 << 16
SEED = 42


def global_rank(rows: DataFrame, group: list[str], cell: str, order: list[str], name: str) -> DataFrame:
    """Rank of each row within its group, from 1, the cells of a group being in order of their keys."""
    counts = rows.groupBy(*group, cell).agg(F.count("*").alias("cell_rows"))
    # One row per cell, thousands of times fewer than rows.
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group, cell, F.coalesce(F.sum("cell_rows").over(before), F.lit(0)).alias("rows_before")
    )
    within = Window.partitionBy(*group, cell).orderBy(*order)
    return (
        rows.join(starts, [*group, cell])
        .withColumn(name, F.col("rows_before") + F.row_number().over(within))
        .drop("rows_before", cell)
    )


def _cell(share: Column, cells: int) -> Column:
    """The cell of a share in [0, 1)."""
    return F.floor(share * cells)


def _numbered_repeats(rows: DataFrame) -> DataFrame:
    """The same rows; the second and further ones of those that are equal have a hash of their own each.
    Equal rows are counted map-side, so one that a third of all rows repeat is a few rows of the shuffle."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {LISTED}")))
    last = F.least(F.col("copies"), (F.col("block") + 1) * LISTED)
    copy = F.explode(F.sequence(F.col("block") * LISTED + 1, last))
    listed = counted.withColumn("block", block).withColumn("copy", copy)
    own = F.when(F.col("copy") == 1, F.col("shuffled")).otherwise(F.xxhash64("shuffled", "copy"))
    return listed.withColumn("shuffled", own).select(*rows.columns)


def stratified_shards(
    docs: DataFrame, shards: int, seed: int = SEED, cell_rows: int = CELL_ROWS, source: str = "source"
) -> DataFrame:
    """Deal rows to shards of equal counts (at most one apart), each with the sources' mixture.

    Returns doc_id, source, size (UTF-8 bytes of the text plus 8), text_crc32, shard and slot (its
    place in the shard, gapless from 0). The order within a source is that of a hash of seed, id and
    text, so it does not depend on files or partitions. Rows that repeat all three are counted and numbered,
    and the number is hashed too, so that they spread over cells and shards like any others.
    A null source is a source of its own, a null text counts as empty in hash, size and checksum.
    Fewer rows than shards leave some shards empty; no rows give none.
    """
    # Seen from the parquet footers; no data is read.
    n = docs.count()
    cells = max(1, -(-n // cell_rows))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("stratum"),
        F.col(source).isNull().alias("no_source"),
        F.col(source).alias("source"),
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), "doc_id", text_of()).alias("shuffled"),
    )
    rows = _numbered_repeats(rows)
    group = ["no_source", "stratum"]
    # The top 53 bits of the hash, as a share of their range.
    share = F.shiftrightunsigned("shuffled", 11) / F.lit(float(1 << 53))
    rows = rows.withColumn("place", F.shiftrightunsigned("shuffled", 1)).withColumn("cell", _cell(share, cells))
    ranked = global_rank(rows, group, "cell", ["place", "doc_id", "text_crc32"], "rank")
    totals = docs.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("stratum"),
        F.col(source).isNull().alias("no_source"),
    ).groupBy(*group).agg(F.count("*").alias("source_rows"))
    fraction = (F.col("rank") - 0.5) / F.col("source_rows")
    interleaved = (
        ranked.join(totals, group)
        .withColumn("fraction", fraction)
        .withColumn("cell", _cell(F.col("fraction"), cells))
    )
    order = ["fraction", "stratum", "no_source"]
    placed = global_rank(interleaved, [], "cell", order, "position").withColumn("at", F.col("position") - 1)
    shard = F.expr(f"at * {shards} div {max(n, 1)}")
    # The first position that falls in a shard: the smallest p with p * shards >= shard * n.
    first = F.expr(f"(shard * {max(n, 1)} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("at") - first).alias("slot"),
    )
