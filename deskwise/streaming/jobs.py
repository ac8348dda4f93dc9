"""Landing, boundary de-duplication and live demand as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from deskwise.sources.tables import Layout, append_rows, read_table, upsert_table

EVENT_TIME = "event_time"


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_batch: int = 0
) -> DataFrame:
    """New files of a landing folder, at most ``files_per_batch`` per micro-batch (0: no cap)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(
    rows: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    output_mode: str = "append",
) -> StreamingQuery:
    """Process everything that has landed, then stop. The checkpoint remembers what was read, so
    the next run resumes after it and a run over nothing new does nothing."""
    query = (
        rows.writeStream.foreachBatch(handle)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_stream(
    rows: DataFrame,
    table: str,
    layout: Layout,
    version: Column,
    checkpoint: str,
    tiebreak: list[Column] | None = None,
) -> StreamingQuery:
    """Continuous landing into a keyed table, each micro-batch applied once."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, table, batch, layout, version, tiebreak)

    return run_available(rows, checkpoint, applied_once(table, checkpoint, merge))


BATCHES = "stream string, batch_id bigint"


def applied_once(
    table: str, stream: str, apply: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A handler that skips what it has applied before.

    The number of an applied batch is kept beside the table, once its rows are in. A batch that Spark hands
    out again, because the run died before its checkpoint was committed, is neither merged nor written then;
    one that died before its number was kept is merged again, to the same rows. Batches come in order, so
    the highest number tells.
    """
    path = f"{table}__batches"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = read_table(spark, path)
        if known is not None:
            last = known.where(F.col("stream") == stream).agg(F.max("batch_id")).first()[0]
            if last is not None and batch_id <= last:
                return
        apply(batch, batch_id)
        append_rows(spark.createDataFrame([(stream, batch_id)], BATCHES), path)

    return handle


def to_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet; the file sink's own log makes each batch exactly-once."""
    query = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def event_timed(rows: DataFrame, moment: str) -> DataFrame:
    """Watermarks need a zoned timestamp: read the zoneless one as UTC (the session zone)."""
    return rows.withColumn(EVENT_TIME, F.col(moment).cast("timestamp"))


def without_rereads(rows: DataFrame, keys: list[str], moment: str, lateness: str) -> DataFrame:
    """Drop rows that overlapping pages landed twice. State is kept for ``lateness`` only."""
    timed = event_timed(rows, moment).withWatermark(EVENT_TIME, lateness)
    return timed.dropDuplicatesWithinWatermark(keys).drop(EVENT_TIME)


def daily_demand(rows: DataFrame, local_moment: str, group: str, lateness: str) -> DataFrame:
    """Requests per local day and group, accepting rows up to ``lateness`` behind the newest.

    ``local_moment`` is the wall-clock time of the reporting zone, so one-day windows are local days.
    """
    return (
        event_timed(rows, local_moment)
        .withWatermark(EVENT_TIME, lateness)
        .groupBy(F.window(EVENT_TIME, "1 day").alias("day"), group)
        .agg(F.count(F.lit(1)).alias("requests_created"))
        .select(F.col("day.start").cast("date").alias("service_date"), group, "requests_created")
    )
