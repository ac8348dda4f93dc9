"""Reading landed feeds: fixed projections, cursors, trailing windows and the weather payload."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwise.functions.cleaning import as_instant
from deskwise.settings import Settings, instant
from deskwise.sources import schemas

CREATED = "created_date"
UPDATED = "resolution_action_updated_date"
# Where a landed row came from: when its file landed, and which it was.
LANDED_AT, LANDED_FILE = "_landed_at", "_landed_file"
# A numbered chunk of a walk, e.g. created-000012.json.
CHUNK_FILE = r"([^/]+)-(\d+)\.json[^/]*$"


def read_requests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Request records (JSON lines or arrays), projected to the declared text fields."""
    return spark.read.schema(schemas.REQUESTS).option("multiLine", False).json(paths)


def read_landed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The same, each record with the file it landed in."""
    return with_landing_order(read_requests(spark, paths))


# Landed bytes per task to aim for.
TASK_BYTES = 64 * 1024 * 1024
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_files(spark: SparkSession, paths: list[str], size: int) -> DataFrame:
    """``read_landed`` for many named files of ``size`` bytes in all. Their number costs little: a task asks
    for the state of a share of them, and tasks read by bytes, not a few files each."""
    with _listed_by(spark, _share(spark)):
        rows = read_landed(spark, paths)
    return rows.coalesce(max(_share(spark), -(-size // TASK_BYTES)))


def _share(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


@contextmanager
def _listed_by(spark: SparkSession, tasks: int) -> Iterator[None]:
    """By default a task asks for one file, up to ten thousand tasks."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def with_landing_order(rows: DataFrame) -> DataFrame:
    """Rows read from files, with the time their file landed at and its path."""
    return rows.select(
        "*",
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias(LANDED_AT),
        F.col("_metadata.file_path").alias(LANDED_FILE),
    )


def landed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files of the landing folder, with the walk and the chunk that a numbered name tells. Their
    contents are not read."""
    name = F.col("path")
    number = F.regexp_extract(name, CHUNK_FILE, 2)
    found = spark.read.format("binaryFile").load(paths).coalesce(_share(spark))
    return found.select(
        "path",
        F.col("modificationTime").cast("timestamp_ntz").alias("landed_at"),
        "length",
        F.nullif(F.regexp_extract(name, CHUNK_FILE, 1), F.lit("")).alias("walk"),
        F.nullif(number, F.lit("")).cast("bigint").alias("chunk_no"),
    )


def files_to_take(landed: DataFrame, taken: DataFrame | None, cap: int = 0) -> DataFrame:
    """Files that no run has taken yet, in the order of their walks, at most ``cap`` of them (0: all).

    A file that was written anew since it was taken counts as another one. Rows of its that were landed
    before merge to the same table.
    """
    if taken is not None:
        landed = landed.join(taken, ["path", "landed_at", "length"], "left_anti")
    if not cap:
        return landed
    return landed.orderBy(F.col("walk").asc_nulls_last(), "chunk_no", "landed_at", "path").limit(cap)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SEED).option("header", True).csv(path)


def typed_requests(landed: DataFrame) -> DataFrame:
    """Give the three landed timestamps their type; leave everything else as text."""
    dtypes = {f.name: f.dataType for f in landed.schema.fields}
    return landed.withColumns({c: as_instant(c, dtypes[c]) for c in (CREATED, UPDATED, "closed_date")})


def unpivot_payload(payloads: DataFrame, body: str, extracted_at: Column | None = None) -> DataFrame:
    """One row per day from JSON objects of parallel arrays.

    A null inside an array stays a null in its row; empty arrays give no rows.
    """
    daily = F.from_json(F.col(body), schemas.WEATHER_PAYLOAD).getField("daily")
    columns = ["time", *schemas.WEATHER_VARIABLES]
    stamp = F.current_timestamp().cast("timestamp_ntz") if extracted_at is None else extracted_at
    return (
        payloads.select(daily.alias("daily"))
        .select(F.inline(F.arrays_zip(*[F.col("daily").getField(c).alias(c) for c in columns])))
        .select(
            F.col("time").try_cast("date").alias("observed_on"),
            *schemas.WEATHER_VARIABLES,
            stamp.alias("_extracted_at"),
        )
    )


def first_cursor(settings: Settings, column: str) -> datetime:
    """Where a cursor starts when no run has committed yet."""
    days = {CREATED: 30 * settings.backfill_months, UPDATED: settings.update_lookback_days}[column]
    return settings.as_of - timedelta(days=days)


def since_cursor(
    landed: DataFrame, column: str, last_value: datetime | None, settings: Settings
) -> DataFrame:
    """Rows at or past the cursor. Inclusive, so rows that share the boundary instant are re-read;
    the keyed merge makes that harmless."""
    start = first_cursor(settings, column) if last_value is None else last_value
    return landed.where(F.col(column) >= instant(start))


def next_cursor(read: DataFrame, column: str, settings: Settings) -> DataFrame:
    """One row with the cursor to commit. Instants past ``as_of`` are ignored: a mistyped date must
    not push the cursor beyond data that is still to come."""
    return read.where(F.col(column) <= settings.now).agg(F.max(column).alias("cursor_value"))


def changed_requests(
    landed: DataFrame,
    settings: Settings,
    cursors: dict[str, datetime | None] | None = None,
    backfill: bool = False,
) -> DataFrame:
    """New requests together with requests whose resolution moved, whenever they were created.

    One scan with an OR of the two cursors: a row that both walks return is landed once. A backfill
    reads the created walk only, since the feed returns current state.
    """
    cursors = cursors or {}
    wanted = [CREATED] if backfill else [CREATED, UPDATED]
    starts = {c: cursors.get(c) or first_cursor(settings, c) for c in wanted}
    predicate = F.lit(False)
    for column, start in starts.items():
        predicate = predicate | (F.col(column) >= instant(start))
    return landed.where(predicate)


def observation_window(settings: Settings, backfill: bool = False) -> tuple[datetime, datetime]:
    """First and last observation day to re-read; always ends yesterday."""
    last = datetime.combine(settings.today, time()) - timedelta(days=1)
    days = 30 * settings.backfill_months if backfill else settings.weather_lookback_days
    return last - timedelta(days=days), last


def trailing_observations(weather: DataFrame, settings: Settings, backfill: bool = False) -> DataFrame:
    first, last = observation_window(settings, backfill)
    return weather.where(
        F.col("observed_on").between(F.lit(first.date()), F.lit(last.date()))
    )


def landing_version() -> Column:
    """Which of two landed copies of a request is the newer one: the copy whose file landed later, whatever
    the dates inside it say. So a correction lands although it lowers a date, as does a request that is
    open again, and re-reading an older file changes nothing."""
    return F.struct(LANDED_AT, LANDED_FILE)


def request_version(settings: Settings) -> Column:
    """Which of two copies of a request is the newer one where nothing tells when they landed, or both
    landed in one file.

    A copy stamped past ``as_of`` is a typing error: it has no version, so it can neither outrank a
    stored row for good nor keep a later correction out.
    """
    moved = F.greatest(UPDATED, CREATED)
    return F.when(moved <= settings.now, moved)


def request_tiebreak() -> list[Column]:
    """Among copies with one version, a closed one, then the latest load, wins."""
    return [F.col("closed_date").desc_nulls_last(), F.col(schemas.LOAD_ID).desc_nulls_last()]
