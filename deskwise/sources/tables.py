"""Parquet tables written by Spark's own writers: naming, partitions, keyed upsert, materialisations.

A table is a folder of Parquet files, partitioned by the month of a day and, below it, by a hash bucket of
the key. An upsert replaces the partitions it touches with a dynamic partition overwrite and leaves the
others as they are; which those are follows from the batch, so a change of one row rewrites one bucket of a
month. A full rebuild is written beside the table and then moved into its place. Tables have one writer at
a time, which jobs see to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwise.functions.calendar import month_label
from deskwise.operators import history
from deskwise.operators.upsert import newest_per_key, not_superseded, replace_rows

MONTH, BUCKET = "month_part", "bucket_part"
PARTS = {MONTH: T.StringType(), BUCKET: T.IntegerType()}
NO_MONTH = "none"


@dataclass(frozen=True)
class Warehouse:
    """Layered table locations: ``root/<prefix><layer>/<table>``, and names: ``<prefix><layer>.<table>``."""

    root: str
    prefix: str = ""

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{layer.strip()}/{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer.strip()}.{table}"


@dataclass(frozen=True)
class Layout:
    """How a table is stored: partitioned by the month of a day and by ``buckets`` of the key, sorted by the
    cluster columns. Take as many buckets as keep one of a month near a few files; 0 means none."""

    keys: list[str]
    month_of: str | None = None
    cluster_by: list[str] = field(default_factory=list)
    buckets: int = 0

    def parts(self) -> dict[str, Column]:
        found = {}
        if self.month_of:
            found[MONTH] = F.coalesce(month_label(F.col(self.month_of)), F.lit(NO_MONTH))
        if self.buckets:
            found[BUCKET] = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return found


# Folder operations go through the Hadoop file system of the path, so they work wherever it lives.


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._new = jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.fs = self._new(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._new(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(name))

    def delete(self, name: str = "") -> None:
        self.fs.delete(self._at(name), True)

    def make(self, name: str = "") -> None:
        self.fs.mkdirs(self._at(name))

    def take(self, other: str) -> None:
        """Become the folder ``other``, which is complete."""
        self.delete()
        if not self.fs.rename(self._new(other), self._at()):
            raise OSError(f"could not move {other} to {self.path}")

    def size(self) -> int:
        """Bytes below the folder (or of the file); a metadata call."""
        return self.fs.getContentSummary(self._at()).getLength() if self.exists() else 0


# Stored bytes per shuffle partition to aim for.
PARTITION_BYTES = 128 * 1024 * 1024
WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_width(spark: SparkSession, paths: list[str]) -> int:
    """Partitions for the shuffles of a run over stored inputs, at least as many as configured.

    AQE packs small partitions together but never splits an aggregation's, so the starting width has
    to follow the data. A job sets WIDTH to it for its session; queries leave the session alone.
    """
    configured = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(WIDTH, None) or 0)
    )
    stored = sum(Folder(spark, p).size() for p in paths)
    return max(configured, -(-stored // PARTITION_BYTES))


# Reading


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame | None:
    """The table, or None before its first write. Partition columns come last.

    A named table has its schema in the catalogue. Otherwise the files' footers are merged, so that files
    written before a column was added read as nulls in it; that reads every footer, in tasks.
    """
    settle(spark, path)
    if not Folder(spark, path).size():
        return None
    schema = (name and _named_schema(spark, path, name)) or _stored_schema(spark, path)
    return spark.read.schema(schema).parquet(path)


def _named_schema(spark: SparkSession, path: str, name: str) -> T.StructType | None:
    """What the catalogue has under the name, if it is the table at the path."""
    if spark.catalog.tableExists(name) and _location(spark, name) == _plain(path):
        return spark.table(name).schema
    return None


def _stored_schema(spark: SparkSession, path: str) -> T.StructType:
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    # A month looks like a date to the reader.
    return T.StructType([T.StructField(f.name, PARTS.get(f.name, f.dataType)) for f in found.fields])


def without_parts(rows: DataFrame | None) -> DataFrame | None:
    return None if rows is None else rows.drop(*PARTS)


# The session's catalogue


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"describe table extended {name}").where("col_name = 'Location'").collect()
    return _plain(rows[0]["data_type"]) if rows else None


def register(spark: SparkSession, path: str, name: str, schema: T.StructType) -> None:
    """Name a stored table for SQL. Its files stay where they are whatever becomes of the name."""
    layer = name.split(".")[0]
    spark.sql(f"create database if not exists {layer} location '{path.rsplit('/', 1)[0]}'")
    spark.sql(f"drop table if exists {name}")
    parts = [part for part in PARTS if part in schema.names]
    partitioned = f"partitioned by ({', '.join(parts)})" if parts else ""
    spark.sql(f"create table {name} ({schema.toDDL()}) using parquet {partitioned} location '{path}'")
    if parts:
        spark.catalog.recoverPartitions(name)


def _widened(stored: T.StructType | None, rows: T.StructType, layout: Layout | None) -> T.StructType:
    """The stored columns, then those that are new, then the partitions."""
    known = [f for f in (stored or []) if f.name not in PARTS]
    new = [f for f in rows if f.name not in {k.name for k in known}]
    parts = layout.parts() if layout else {}
    return T.StructType([*known, *new, *(T.StructField(p, PARTS[p]) for p in parts)])


# Writing


def _sorted_for(rows: DataFrame, layout: Layout) -> DataFrame:
    """REBALANCE lets AQE size the write tasks from the measured shuffle: a partition (or one cluster value)
    with a third of all rows is split over many tasks, and small ones are packed together."""
    order = [*layout.parts(), *layout.cluster_by]
    labelled = rows.withColumns(layout.parts())
    return labelled.hint("rebalance", *order).sortWithinPartitions(*order) if order else labelled


def settle(spark: SparkSession, path: str) -> None:
    """Finish a rebuild that ended between removing the old folder and moving the new one there."""
    if not Folder(spark, path).exists() and Folder(spark, _next(path)).exists("_SUCCESS"):
        Folder(spark, path).take(_next(path))


def _next(path: str) -> str:
    return f"{path}__next"


def overwrite_table(rows: DataFrame, path: str, layout: Layout | None = None) -> None:
    """Replace a table in full. A run that dies leaves the old contents or the new."""
    spark = rows.sparkSession
    settle(spark, path)
    written = rows if layout is None else _sorted_for(rows, layout)
    writer = written.write.mode("overwrite")
    if layout is not None and layout.parts():
        writer = writer.partitionBy(*layout.parts())
    writer.parquet(_next(path))
    Folder(spark, path).take(_next(path))


def write_clustered(rows: DataFrame, path: str, layout: Layout) -> None:
    """Partitions whose files are sorted by the cluster columns, as the table's whole contents."""
    overwrite_table(rows, path, layout)


def _labels(rows: DataFrame, parts: list[str]) -> set[tuple]:
    """The partitions of the rows: at most as many as the table has."""
    return {tuple(r) for r in rows.select(*parts).distinct().collect()}


def _within(parts: list[str], labels: set[tuple]) -> Column:
    """A filter on partition columns alone, so that other partitions are not even listed for reading."""
    label = F.concat_ws("/", *[F.col(p).cast("string") for p in parts])
    return label.isin(sorted("/".join(map(str, values)) for values in labels))


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    layout: Layout,
    version: Column | None = None,
    tiebreak: list[Column] | None = None,
) -> list[str]:
    """Merge a batch into a table, rewriting only the partitions it touches. Returns those, as folders.

    A key stays in its bucket but can move between months when its day is corrected, so the touched
    partitions are those of the batch and those where its keys are stored now, which are looked for in the
    batch's buckets only. The batch is written out first: it is read several times below, and it may itself
    be derived from the table. A run that dies before the overwrite is committed leaves the table as it
    was; repeating it ends the same.
    """
    if version is not None:
        batch = newest_per_key(batch, layout.keys, [version.desc_nulls_last(), *(tiebreak or [])])
    target, parts = read_table(spark, path), list(layout.parts())
    if target is None:
        overwrite_table(batch, path, layout)
        target = read_table(spark, path)
        return [] if target is None else sorted(map(_folder(parts), _labels(target, parts)))

    held = f"{path}__batch-{uuid.uuid4().hex}"
    batch = _kept_beside(batch.withColumns(layout.parts()), f"{held}/all")
    arriving = _labels(batch, parts)
    near = target
    if layout.buckets:
        near = target.where(F.col(BUCKET).isin(sorted({values[parts.index(BUCKET)] for values in arriving})))
    if version is not None:
        # Rows that a newer stored one supersedes touch nothing, nor the partition they would go to.
        batch = _kept_beside(not_superseded(near, batch, layout.keys, version), f"{held}/newer")
        arriving = _labels(batch, parts)
    leaving = _labels(near.join(batch.select(*layout.keys), layout.keys, "left_semi"), parts) - arriving
    touched = arriving | leaving
    if touched:
        own = target.where(_within(parts, touched)) if parts else target
        merged = replace_rows(own.drop(*PARTS), batch.drop(*PARTS), layout.keys)
        staying = own.where(_within(parts, leaving)).join(batch.select(*layout.keys), layout.keys, "left_anti")
        emptied = leaving - _labels(staying, parts) if leaving else set()
        if parts:
            (_sorted_for(merged, layout).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
        else:
            overwrite_table(merged, path, layout)
        # A partition all of whose keys have moved away is not in the result, so nothing overwrote it.
        for values in emptied:
            Folder(spark, path).delete(_folder(parts)(values))
    Folder(spark, held).delete()
    return sorted(map(_folder(parts), touched))


def _kept_beside(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _folder(parts: list[str]) -> Callable[[tuple], str]:
    return lambda values: "/".join(f"{p}={v}" for p, v in zip(parts, values, strict=True))


def append_rows(rows: DataFrame, path: str) -> None:
    """Add rows to an unpartitioned table. Columns that only one side has are null in the other."""
    rows.write.mode("append").parquet(path)


def write_extract(rows: DataFrame, path: str) -> None:
    """A report extract: thousands of rows, which AQE packs into one file or a few. Coalescing here
    would instead pull the last aggregation into a single task. Readers see the old one or the new."""
    overwrite_table(rows, path)


# Type-2 history in two parts


@dataclass(frozen=True)
class Snapshot:
    """How a source is kept as a history: by key, a version for each later ``changed_at``; of several rows of
    a key that changed at once, the first by ``tiebreak`` counts."""

    key: str
    changed_at: str
    tiebreak: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    buckets: int = 8

    def current(self) -> Layout:
        return Layout([self.key], None, list(self.cluster_by), self.buckets)

    def closed(self) -> Layout:
        return Layout([history.SCD_ID], history.VALID_TO, list(self.cluster_by), self.buckets)


def snapshot_table(source: DataFrame, path: str, how: Snapshot) -> None:
    """Take the source into the history below ``path``.

    ``current`` has the open version of each key and is all that is read to find what changed. A version
    that a later one follows goes to ``closed`` first, by its id, and is replaced in ``current`` then: a
    run that dies in between is repeated without a trace, as the same version is closed again.
    """
    spark = source.sparkSession
    current = without_parts(read_table(spark, f"{path}/current"))
    held = f"{path}/opened__{uuid.uuid4().hex}"
    history.new_versions(current, source, how.key, how.changed_at, [F.col(c) for c in how.tiebreak]).write.parquet(held)
    opened = spark.read.parquet(held)
    if current is not None:
        upsert_table(spark, f"{path}/closed", history.closed_by(current, opened, how.key), how.closed())
    upsert_table(spark, f"{path}/current", opened, how.current())
    Folder(spark, held).delete()


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The open versions: stored as they are, so neither sorted nor compared."""
    current = without_parts(read_table(spark, f"{path}/current"))
    return None if current is None else current.withColumn(history.VALID_TO, F.lit(None).cast("timestamp_ntz"))


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    current, closed = read_current(spark, path), without_parts(read_table(spark, f"{path}/closed"))
    if current is None or closed is None:
        return current
    return current.unionByName(closed)


# Materialisations


@dataclass(frozen=True)
class Model:
    """How a model is kept: ``ephemeral`` stays lazy, ``view`` is also named for SQL, ``table`` is rebuilt in
    full, ``incremental`` is merged by key into the partitions it touches, ``snapshot`` is kept as a history."""

    kind: str
    layout: Layout | None = None
    snapshot: Snapshot | None = None
    version: Column | None = None
    tiebreak: tuple[Column, ...] = ()


def materialise(model: Model, rows: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Keep the rows of a model as it asks for, and return it as readers see it. A name with a layer before
    it is the table's in the catalogue too."""
    spark = rows.sparkSession
    if model.kind == "ephemeral":
        return rows
    if model.kind == "view":
        rows.createOrReplaceTempView(name)
        return rows
    if model.kind == "snapshot":
        snapshot_table(rows, path, model.snapshot)
        return read_history(spark, path)
    stored = None
    if model.kind == "incremental":
        before = read_table(spark, path, name)
        stored = before and before.schema
        upsert_table(spark, path, rows, model.layout, model.version, list(model.tiebreak))
    elif model.kind == "table":
        overwrite_table(rows, path, model.layout)
    else:
        raise ValueError(f"unknown materialisation {model.kind}")
    register(spark, path, name, _widened(stored, rows.schema, model.layout))
    return without_parts(read_table(spark, path, name))
