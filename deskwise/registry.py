"""Every query by name, over the benchmark tables.

Each callable takes a session and a table folder and reads whole tables. Queries that write do so
under the session's shared scratch folder and return what they wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwise.functions import bands
from deskwise.functions.keys import surrogate_key
from deskwise.operators import counting, history, quality, sketches
from deskwise.operators.upsert import merge_rows, watermark
from deskwise.plans import checks, dimensions, facts, intermediate, reports, staging
from deskwise.plans.nightly import DAILY_LAYOUT, FACT_LAYOUT, REQUESTS_LAYOUT, STATUS, Job
from deskwise.session import scratch_dir, session_zone
from deskwise.settings import Settings, instant
from deskwise.sources import adapters, audit, landing, schemas, tables
from deskwise.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

AGENCY = "A1"


class Feed:
    """The models over one adapter, each built on first use and all of them lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings):
        self.spark, self.sf_dir, self.settings = spark, sf_dir, settings

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stg_requests(self.raw)

    @cached_property
    def requests(self) -> DataFrame:
        return intermediate.int_requests(self.staged, self.seed, self.settings)

    @cached_property
    def staged_weather(self) -> DataFrame:
        return staging.stg_weather(self.raw_weather)

    @cached_property
    def weather(self) -> DataFrame:
        """One row per day; adaptive execution measures it and picks the join."""
        return intermediate.int_weather_banded(self.staged_weather)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.settings)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dimensions.dim_location(self.spark)

    @cached_property
    def dim_category(self) -> DataFrame:
        return dimensions.dim_category(self.seed)

    @cached_property
    def dim_weather_band(self) -> DataFrame:
        return dimensions.dim_weather_band(self.spark)

    @cached_property
    def dim_agency(self) -> DataFrame:
        return dimensions.dim_agency(self.staged)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fct_requests(self.requests, self.weather, self.dim_date, self.settings)

    @cached_property
    def daily(self) -> DataFrame:
        return facts.fct_daily(
            self.fact, self.dim_date, self.dim_location, self.dim_category, self.weather
        )

    @cached_property
    def performance(self) -> DataFrame:
        return reports.agency_performance(self.fact, self.dim_agency)

    @cached_property
    def extract(self) -> DataFrame:
        return reports.daily_extract(self.daily)

    @cached_property
    def heat(self) -> DataFrame:
        return reports.heat_season(self.dim_date, self.fact, self.daily)


class Events(Feed):

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = adapters.EVENTS):
        super().__init__(spark, sf_dir, settings)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def raw(self) -> DataFrame:
        return adapters.requests_from_events(self.events)

    @cached_property
    def seed(self) -> DataFrame:
        return adapters.event_seed(self.spark)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return adapters.weather_from_events(self.events)

    @cached_property
    def loads(self) -> DataFrame:
        return adapters.loads_from_events(self.events)


class Extract(Events):
    """The events feed as it stood at the settings' clock."""

    @cached_property
    def raw(self) -> DataFrame:
        return adapters.extract_as_of(
            adapters.requests_from_events(self.events), self.settings.as_of
        )


class Orders(Feed):

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir, adapters.ORDERS)

    @cached_property
    def raw(self) -> DataFrame:
        names = ("orders", "lineitem", "customer", "nation", "region")
        return adapters.requests_from_orders(*map(self.table, names))

    @cached_property
    def seed(self) -> DataFrame:
        return adapters.order_seed(self.spark)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return adapters.weather_from_orders(self.table("orders"))


class AllOrders(Orders):
    """Every order: the clock, the window and the calendar follow from the first and the last of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        # Two values, from the files' statistics.
        first, last = self.table("orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
        if first is not None:
            months = (last.year - first.year) * 12 + last.month - first.month + 2
            # An order's local day is the one before where it is dated by midnight in UTC.
            self.settings = Settings(
                as_of=datetime(last.year, last.month, last.day) + timedelta(days=1),
                analysis_window_months=months,
                spine_start=first.date() - timedelta(days=1),
            )


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    """Sums of fractions depend on the order of addition in their last digits; six are compared."""
    return rows.withColumns({c: F.round(c, 6) for c in columns})


def stored(rows: DataFrame, purpose: str, layout: tables.Layout | None = None) -> DataFrame:
    """Rows written to the shared scratch folder and read back, as the nightly job stores its marts."""
    path = scratch_dir(rows.sparkSession, purpose)
    tables.overwrite_table(rows, path, layout)
    return _read(rows.sparkSession, path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return tables.without_parts(tables.read_table(spark, path))


# Staging and intermediate models


def stg_requests(spark, sf):
    return Events(spark, sf).staged


def stg_weather(spark, sf):
    return Events(spark, sf).staged_weather


def int_requests(spark, sf):
    return Events(spark, sf).requests


def int_weather_banded(spark, sf):
    return Orders(spark, sf).weather


def _band_counts(spark, sf, band: str, ladder: bands.Ladder, value):
    events = Events(spark, sf).events
    return events.groupBy(ladder.of(value).alias(band)).agg(F.count(F.lit(1)).alias("readings"))


def temp_band_ladder(spark, sf):
    value = F.when(F.col("event_id") % 17 != 0, F.round(F.col("value") % 100, 1))
    return _band_counts(spark, sf, "temp_band", bands.TEMPERATURE, value)


def precip_band_ladder(spark, sf):
    value = F.when(F.col("event_id") % 17 != 0, F.round((F.col("event_id") % 70) / 100, 2))
    return _band_counts(spark, sf, "precip_band", bands.PRECIPITATION, value)


def snow_band_ladder(spark, sf):
    value = F.when(F.col("event_id") % 17 != 0, F.round((F.col("event_id") % 40) / 10, 1))
    return _band_counts(spark, sf, "snow_band", bands.SNOW, value)


def surrogate_keys(spark, sf):
    staged = Events(spark, sf).staged
    return staged.select(
        "request_id",
        surrogate_key("agency_code", "borough_name").alias("place_key"),
        surrogate_key(F.col("created_at").cast("date"), "complaint_type").alias("day_type_key"),
    )


# Dimensions, each with the demand that points at it


def _requests_per(feed: Feed, dimension: DataFrame, key: str, fact_key: str | None = None):
    demand = feed.fact.groupBy(F.col(fact_key or key).alias(key)).agg(
        F.count(F.lit(1)).alias("requests_created")
    )
    return dimension.join(demand, key, "left").withColumn(
        "requests_created", F.coalesce("requests_created", F.lit(0))
    )


def dim_date(spark, sf):
    feed = Events(spark, sf)
    return _requests_per(feed, feed.dim_date, "date_key", "created_date_local")


def dim_agency(spark, sf):
    return Events(spark, sf).dim_agency


def dim_location(spark, sf):
    feed = Events(spark, sf)
    return _requests_per(feed, feed.dim_location, "location_key")


def dim_category(spark, sf):
    feed = Events(spark, sf)
    return _requests_per(feed, feed.dim_category, "complaint_category_key")


def dim_weather_band(spark, sf):
    feed = Events(spark, sf)
    return _requests_per(feed, feed.dim_weather_band, "weather_band_key")


# Facts


def fct_requests(spark, sf):
    return Events(spark, sf).fact


def fct_daily(spark, sf):
    return Events(spark, sf).daily


def fct_orders(spark, sf):
    return Orders(spark, sf).fact


def orders_daily(spark, sf):
    return AllOrders(spark, sf).daily


# Reports


def agency_performance(spark, sf):
    return Events(spark, sf).performance


def daily_service_levels(spark, sf):
    return Events(spark, sf).extract


def heat_season(spark, sf):
    return AllOrders(spark, sf).heat


def _freshness(feed: Events):
    return reports.pipeline_freshness(feed.loads, feed.fact, feed.settings)


def freshness(spark, sf):
    return _freshness(Events(spark, sf))


def freshness_banner(spark, sf):
    feed = Events(spark, sf)
    return reports.freshness_banner(_freshness(feed), feed.settings)


def citywide_daily(spark, sf):
    return reports.citywide_daily(Events(spark, sf).extract)


def citywide_order(spark, sf):
    """The citywide report with the place of each row in the order it is returned in."""
    ordered = reports.citywide_daily(Events(spark, sf).extract).withColumn("at", F.monotonically_increasing_id())
    # A row per day.
    place = F.row_number().over(Window.orderBy("at")).cast("bigint")
    return ordered.withColumn("place", place).select("service_date", "place")


def agency_rollup(spark, sf):
    return rounded(reports.agency_rollup(Events(spark, sf).performance), "avg_resolution_hours")


def top_agencies(spark, sf):
    return rounded(reports.top_agencies(Events(spark, sf).performance), "avg_resolution_hours")


def by_borough_category(spark, sf):
    return reports.by_borough_category(Events(spark, sf).extract)


def service_level_trend(spark, sf):
    return reports.service_level_trend(Events(spark, sf).extract)


def sketch_percentiles(spark, sf):
    """Percentiles of months from daily sketches, merged, beside the exact ones: whether the rank of what
    the sketches return is within the promised error."""
    keys = ["borough_name", "service_category"]
    fact = Events(spark, sf).fact.where(F.col("closed_date_local").isNotNull())
    hours, month = "reportable_resolution_hours", F.trunc("closed_date_local", "month").alias("month")
    daily = sketches.sketched(fact, [*keys, "closed_date_local"], hours)
    monthly = sketches.merged(daily.select(*keys, month, sketches.SKETCH), [*keys, "month"])
    near = monthly.select(
        *keys, "month", sketches.size().alias("closures_measured"),
        sketches.percentile(50).alias("median"), sketches.percentile(90).alias("p90"),
    )
    rows = fact.select(*keys, month, hours)
    wanted = {"median": 50, "p90": 90}
    errors = sketches.rank_error(rows, [*keys, "month"], hours, near, wanted)
    counts = rows.where(F.col(hours).isNotNull()).groupBy(*keys, "month", hours).agg(F.count(F.lit(1)).alias("n"))
    exact = counting.running_counts(counts, [*keys, "month"], hours, "n").groupBy(*keys, "month").agg(
        counting.percentile(hours, 50).alias("median_resolution_hours"),
        counting.percentile(hours, 90).alias("p90_resolution_hours"),
    )
    return (
        near.drop("median", "p90").join(exact, [*keys, "month"]).join(errors, [*keys, "month"])
        .withColumn("median_within_bound", F.col("median") <= sketches.RANK_ERROR)
        .withColumn("p90_within_bound", F.col("p90") <= sketches.RANK_ERROR)
        .drop("median", "p90")
    )


def agencies(spark, sf):
    return reports.agencies(Events(spark, sf).performance)


def agency_selected(spark, sf):
    performance = Events(spark, sf).performance
    return rounded(reports.agency_selected(performance, AGENCY), "avg_resolution_hours")


def top_selected(spark, sf):
    performance = Events(spark, sf).performance
    return rounded(reports.top_selected(performance, AGENCY), "avg_resolution_hours")


def agency_totals(spark, sf):
    performance = Events(spark, sf).performance
    return rounded(reports.agency_totals(performance, AGENCY), "avg_resolution_hours")


def agency_by_borough(spark, sf):
    performance = Events(spark, sf).performance
    return rounded(reports.agency_by_borough(performance, AGENCY), "avg_resolution_hours")


def heat_daily(spark, sf):
    return reports.heat_daily(Events(spark, sf).heat)


def in_season(spark, sf):
    return reports.heat_by_temperature(AllOrders(spark, sf).heat, in_season=True)


def out_of_season(spark, sf):
    return reports.heat_by_temperature(AllOrders(spark, sf).heat, in_season=False)


def by_weather(spark, sf):
    return reports.by_weather(Events(spark, sf).extract)


def snow_days(spark, sf):
    return rounded(reports.snow_days(Events(spark, sf).extract), "avg_resolution_hours")


# Landing


def cursor_read(spark, sf):
    """Rows at or past a committed cursor, with the cursor the run would commit next."""
    feed = Extract(spark, sf, adapters.SECOND)
    read = landing.since_cursor(feed.raw, landing.UPDATED, datetime(2024, 1, 20), feed.settings)
    following = landing.next_cursor(read, landing.UPDATED, feed.settings)
    return read.withColumn("next_cursor", following.scalar())


CURSORS = {landing.CREATED: datetime(2024, 1, 25), landing.UPDATED: datetime(2024, 1, 20)}


def dual_cursor(spark, sf):
    feed = Extract(spark, sf, adapters.SECOND)
    return landing.changed_requests(feed.raw, feed.settings, CURSORS)


def _with_rereads(rows: DataFrame, every: int) -> DataFrame:
    """Overlapping pages: every n-th row landed twice."""
    copies = F.when(F.col("unique_key").cast("bigint") % every == 0, 2).otherwise(1)
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")


def raw_upsert(spark, sf):
    """Two walks of the feed merged by key; the second re-reads rows and holds duplicates."""
    first, second = Extract(spark, sf, adapters.FIRST), Extract(spark, sf, adapters.SECOND)
    batch = landing.changed_requests(_with_rereads(second.raw, 10), second.settings, CURSORS)
    version = landing.request_version(second.settings)
    return merge_rows(first.raw, batch, ["unique_key"], version, landing.request_tiebreak())


def raw_upsert_table(spark, sf):
    """The same merge through the stored table, rewriting only the partitions the batch touches."""
    first, second = Extract(spark, sf, adapters.FIRST), Extract(spark, sf, adapters.SECOND)
    batch = landing.changed_requests(_with_rereads(second.raw, 10), second.settings, CURSORS)
    path = scratch_dir(spark, "raw-upsert")
    version = landing.request_version(second.settings)
    for rows in (first.raw, batch):
        tables.upsert_table(spark, path, rows, REQUESTS_LAYOUT, version, landing.request_tiebreak())
    return _read(spark, path)


def trailing_reload(spark, sf):
    """Provisional observations overwritten by the settled ones of the trailing window."""
    feed = Events(spark, sf)
    settled = feed.raw_weather
    provisional = settled.withColumns(
        {c: F.col(c) + 1 for c in ("temperature_2m_max", "temperature_2m_min", "temperature_2m_mean")}
    )
    window = landing.trailing_observations(settled, feed.settings)
    return merge_rows(provisional, window, ["observed_on"])


def payload_unpivot(spark, sf):
    """Monthly weather payloads of parallel arrays, back to one row per day.

    A payload holds one month, so no array exceeds 31 entries.
    """
    weather = Events(spark, sf).raw_weather
    month = F.date_format("observed_on", "yyyy-MM").alias("month")
    day = F.struct(F.col("observed_on").cast("string").alias("time"), *schemas.WEATHER_VARIABLES)
    months = weather.groupBy(month).agg(F.sort_array(F.collect_list(day)).alias("days"))
    arrays = [F.col("days").getField(c).alias(c) for c in ("time", *schemas.WEATHER_VARIABLES)]
    body = F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("body")
    payloads = months.select(body)
    return landing.unpivot_payload(payloads, "body", instant(adapters.EVENTS_AS_OF))


PAGE = 16


def extract_audit(spark, sf):
    """The events as one walk per type, landed in pages by id with an hourly cursor. Busy hours
    overflow a page (stalled), some pages open a new hour (gap) or lack a type (missing_before)."""
    chunks = Events(spark, sf).events.select(
        F.col("event_type").alias("walk"),
        F.floor(F.col("event_id") / PAGE).alias("chunk_no"),
        (F.col("ts").cast("date").cast("timestamp_ntz") + adapters.minutes(F.hour("ts") * 60)).alias("cursor"),
    )
    return audit.chunk_findings(chunks, "cursor")


def extract_audit_edges(spark, sf):
    """One walk per user over all pages of the table: whose first or last page holds no event of theirs."""
    events = Events(spark, sf).events
    page = F.floor(F.col("event_id") / PAGE)
    chunks = events.select(F.col("user_id").alias("walk"), page.alias("chunk_no"))
    first, last = events.agg(F.min(page)).scalar(), events.agg(F.max(page)).scalar()
    walks = chunks.select("walk").distinct().select("walk", first.alias("first_no"), last.alias("last_no"))
    return audit.edge_findings(chunks, walks)


def extract_manifest(spark, sf):
    """Orders, as the manifest, of which no line has landed."""
    feed = Orders(spark, sf)
    manifest = feed.table("orders").select("o_orderkey")
    landed = feed.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.never_landed(manifest, landed, "o_orderkey")


def landing_json(spark, sf):
    """Records landed as JSON text, read back by the declared schema and typed."""
    return landing.typed_requests(landing.read_requests(spark, _landed_json(spark, sf)))


def _landed_json(spark, sf) -> str:
    path = scratch_dir(spark, "landing")
    _as_json(Events(spark, sf).raw).write.json(path)
    return path


def _as_json(raw: DataFrame) -> DataFrame:
    """Requests as the feed writes them."""
    stamps = {
        c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        for c in (landing.CREATED, landing.UPDATED, "closed_date")
    }
    return raw.withColumns(stamps).drop(schemas.LOAD_ID)


# Runs a capped landing is spread over, and one more that finds nothing.
CAPPED_RUNS = 3
LANDING_ROWS = 200


def _landed_in_runs(spark, sf) -> Job:
    """The feed landed by several runs of the nightly job, each with a cap on the files it takes."""
    source = scratch_dir(spark, "landing")
    # However the events are stored, all cores write files of them.
    spread = _as_json(Events(spark, sf).raw).hint("rebalance", "unique_key")
    writer = spread.write.option("maxRecordsPerFile", LANDING_ROWS)
    # Nobody reads the folder before it is whole: tasks move their files there, not the driver one by one.
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(source)
    files = landing.landed_files(spark, source).count()
    capped = replace(adapters.EVENTS, max_chunks_per_run=-(-files // CAPPED_RUNS))
    job = Job(spark, tables.Warehouse(scratch_dir(spark, "warehouse")), capped)
    for run in range(CAPPED_RUNS + 1):
        job.land_requests(source, f"run-{run}")
    return job


def capped_landing(spark, sf):
    """What several capped runs have landed: every record once, however the files fell to them."""
    return _landed_in_runs(spark, sf).read("raw", "service_requests").select(*schemas.REQUEST_FIELDS)


def load_ledger(spark, sf):
    """The ledger of those runs: one row each, the last of which took nothing."""
    job = _landed_in_runs(spark, sf)
    took = job.read("raw", "service_requests").select(F.col(schemas.LOAD_ID).alias("load_id")).distinct()
    return job.read("raw", "loads").join(took.withColumn("took", F.lit(True)), "load_id", "left").select(
        "load_id", "status", F.coalesce("took", F.lit(False)).alias("landed_rows")
    )


def agency_sightings(spark, sf):
    """What the agency dimension is made of, kept up run by run."""
    return _landed_in_runs(spark, sf).read("raw", "agency_sightings")


def raw_upsert_landed(spark, sf):
    """A later landing takes some closures back and corrects others to an earlier time: it wins although
    its dates do not. The first landing, read again, changes nothing."""
    first = Extract(spark, sf, adapters.FIRST).raw
    turn = F.col("unique_key").cast("bigint") % 7
    reopened, earlier = turn == 0, turn == 1
    closed = F.when(earlier, F.col("closed_date") - adapters.minutes(F.lit(90))).when(~reopened, F.col("closed_date"))
    second = first.where(turn < 2).withColumns(
        {
            "closed_date": closed,
            landing.UPDATED: closed,
            "status": F.when(reopened, "Open").otherwise(F.col("status")),
        }
    )
    source, path = scratch_dir(spark, "landing"), scratch_dir(spark, "raw-landed")
    inside = [landing.request_version(adapters.FIRST).desc_nulls_last()]
    for name, rows in (("1", first), ("2", second)):
        _as_json(rows).write.json(f"{source}/{name}")
    for name in ("1", "2", "1"):
        batch = landing.typed_requests(landing.read_landed(spark, f"{source}/{name}"))
        tables.upsert_table(spark, path, batch, REQUESTS_LAYOUT, landing.landing_version(), inside)
    return _read(spark, path).select(*schemas.REQUEST_FIELDS)


def seed_demand(spark, sf):
    """The category map landed as CSV and read by its declared types, with the demand of each type."""
    path, feed = scratch_dir(spark, "seed"), Events(spark, sf)
    feed.seed.coalesce(1).write.option("header", True).csv(path)
    demand = feed.staged.groupBy("complaint_type").agg(F.count(F.lit(1)).alias("requests_created"))
    return landing.read_seed(spark, path).join(demand, "complaint_type", "left").withColumn(
        "requests_created", F.coalesce("requests_created", F.lit(0))
    )


def resumable_ingest(spark, sf):
    """The same records taken in bounded chunks; the second run finds nothing new to take."""
    source, out = _landed_json(spark, sf), scratch_dir(spark, "ingest")
    for _ in range(2):
        stream = jobs.landing_stream(spark, source, schemas.REQUESTS, files_per_batch=64)
        jobs.to_files(stream, f"{out}/rows", f"{out}/checkpoint")
    return landing.typed_requests(spark.read.schema(schemas.REQUESTS).parquet(f"{out}/rows"))


def additive_columns(spark, sf):
    """A batch with columns the stored rows lack: older rows read as null in them."""
    first, second = Extract(spark, sf, adapters.FIRST), Extract(spark, sf, adapters.SECOND)
    target = first.staged.drop("channel_type", "latitude", "longitude")
    return merge_rows(target, second.staged, ["request_id"])


def clustered_sink(spark, sf):
    """The fact stored by month and clustered, then summarised per stored month: with how many rows of its
    files follow one that should come behind them."""
    path = scratch_dir(spark, "clustered")
    tables.write_clustered(Events(spark, sf).fact, path, FACT_LAYOUT)
    stored = tables.read_table(spark, path).withColumns(
        {"file": F.col("_metadata.file_path"), "cluster": F.struct(*FACT_LAYOUT.cluster_by),
         "place": F.col("_metadata.row_index")}
    )
    # A file is bounded by what one task writes.
    before = F.lag("cluster").over(Window.partitionBy("file").orderBy("place"))
    return (
        stored.withColumn("before", before)
        .groupBy(tables.MONTH)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if("is_closed").alias("closed"),
            F.count_if(F.col("before") > F.col("cluster")).alias("out_of_order"),
        )
    )


def stored_extract(spark, sf):
    """A report written to its layer of a warehouse and read back by its name in the catalogue."""
    warehouse = tables.Warehouse(scratch_dir(spark, "warehouse"), f"w{uuid.uuid4().hex[:8]}_")
    name, path = (make("reports", "agency_performance") for make in (warehouse.name, warehouse.path))
    tables.materialise(tables.Model("table"), Events(spark, sf).performance, name, path)
    return spark.table(name)


# Incremental fact and history


def _incremental_batch(spark, sf, target: DataFrame) -> DataFrame:
    feed = Extract(spark, sf, adapters.SECOND)
    return facts.fct_requests(feed.requests, feed.weather, feed.dim_date, feed.settings, target)


def incremental_merge(spark, sf):
    target = Extract(spark, sf, adapters.FIRST).fact
    return facts.merged_requests(target, _incremental_batch(spark, sf, target))


def lookback_watermark(spark, sf):
    """Where an incremental run starts reading a fact that holds movements later than its clock."""
    return watermark(Events(spark, sf).fact, "resolution_updated_at", "created_at", adapters.SECOND)


def incremental_merge_table(spark, sf):
    """The same merge through the stored table."""
    path = scratch_dir(spark, "fact")
    tables.upsert_table(spark, path, Extract(spark, sf, adapters.FIRST).fact, FACT_LAYOUT)
    target = _read(spark, path)
    tables.upsert_table(spark, path, _incremental_batch(spark, sf, target), FACT_LAYOUT)
    return _read(spark, path)


def _sources(spark, sf) -> list[DataFrame]:
    extracts = [Extract(spark, sf, s) for s in (adapters.FIRST, adapters.SECOND)]
    return [facts.snapshot_source(x.staged, x.settings) for x in extracts]


def _snapshots(spark, sf, sources: list[DataFrame]) -> str:
    """The folder of a history that has taken the sources one after the other."""
    path = scratch_dir(spark, "history")
    for source in sources:
        tables.snapshot_table(source, path, STATUS)
    return path


def _history(spark, sf) -> DataFrame:
    return tables.read_history(spark, _snapshots(spark, sf, _sources(spark, sf)))


def scd2_history(spark, sf):
    """Versions of two runs: the open ones, and those that later ones closed."""
    return _history(spark, sf)


def scd2_replayed(spark, sf):
    """History after the second extract is taken again: nothing opens, so nothing changes."""
    first, second = _sources(spark, sf)
    return tables.read_history(spark, _snapshots(spark, sf, [first, second, second]))


def scd2_current(spark, sf):
    """The open version of each request, read as it is stored."""
    return tables.read_current(spark, _snapshots(spark, sf, _sources(spark, sf)))


def scd2_point_in_time(spark, sf):
    """Status of every tracked request at noon of the day after it was created."""
    probes = Events(spark, sf).staged.select(
        "request_id",
        (F.date_add(F.col("created_at").cast("date"), 1).cast("timestamp_ntz") + adapters.minutes(F.lit(720))).alias(
            "asked_at"
        ),
    )
    versions = _history(spark, sf).select("request_id", "status", history.VALID_FROM, history.VALID_TO)
    return history.as_of_join(probes, versions, "request_id", "asked_at")


def time_in_status(spark, sf):
    return history.time_in_status(_history(spark, sf), ["status", "agency_code"])


def stale_open_versions(spark, sf):
    versions = _history(spark, sf)
    return history.stale_open(
        versions, _sources(spark, sf)[1], "request_id", F.col("status") == "Open"
    ).select("request_id", "status", history.VALID_FROM)


# Quality


def _checked_models(spark, sf) -> tuple[dict[str, DataFrame], dict[str, quality.RowTerms]]:
    """Every checked table of the events feed, and the row checks that were counted while the marts were
    stored. Requests pass through all of their models on the way to the fact, so that one scan counts the
    checks of the raw rows, the staged, the measured and the fact's."""
    feed, watched = Events(spark, sf), Events(spark, sf)
    # Weather and calendar are a row per day; the agency dimension a row per code.
    weather = stored(feed.raw_weather, "weather")
    staged_weather = staging.stg_weather(weather)
    banded = intermediate.int_weather_banded(staged_weather)
    names = ("service_requests", "stg_requests", "int_requests", "fct_requests", "fct_daily", "dim_agency")
    counted = {name: checks.row_terms(name, adapters.SECOND) for name in names}
    watched.raw = counted["service_requests"].attach(feed.raw)
    watched.staged = counted["stg_requests"].attach(staging.stg_requests(watched.raw))
    watched.requests = counted["int_requests"].attach(
        intermediate.int_requests(watched.staged, feed.seed, feed.settings)
    )
    passing = facts.fct_requests(watched.requests, banded, feed.dim_date, feed.settings)
    fact = stored(counted["fct_requests"].attach(passing), "fact", FACT_LAYOUT)
    daily = facts.fct_daily(fact, feed.dim_date, feed.dim_location, feed.dim_category, banded)
    models = {
        "service_requests": feed.raw,
        "weather_daily": weather,
        "loads": feed.loads,
        "seed": feed.seed,
        "stg_requests": feed.staged,
        "stg_weather": staged_weather,
        "int_requests": feed.requests,
        "int_weather_banded": banded,
        "dim_date": feed.dim_date,
        "dim_category": feed.dim_category,
        "dim_agency": stored(counted["dim_agency"].attach(feed.dim_agency), "agency"),
        "dim_location": feed.dim_location,
        "dim_weather_band": feed.dim_weather_band,
        "fct_requests": fact,
        "fct_daily": stored(counted["fct_daily"].attach(daily), "daily", DAILY_LAYOUT),
        "snp_request_status": stored(_history(spark, sf), "history"),
    }
    return models, counted


def dq_summary(spark, sf):
    """All declared and cross-table checks with their outcomes, at a clock that makes some of the
    closures lie in the future."""
    models, counted = _checked_models(spark, sf)
    return checks.run_checks(models, adapters.SECOND, counted)


def dq_row_checks(spark, sf):
    """The fused single-pass checks of the fact alone."""
    declared = checks.DECLARED["fct_requests"]
    named = checks.predicates("fct_requests", declared, adapters.SECOND)
    return quality.row_findings(Events(spark, sf).fact, named)


def dq_relationships(spark, sf):
    """Foreign keys of the orders fact. Orders past the calendar's end are orphans of it."""
    feed = Orders(spark, sf)
    parents = {
        "dim_category": feed.dim_category,
        "dim_agency": feed.dim_agency,
        "dim_location": feed.dim_location,
        "dim_weather_band": feed.dim_weather_band,
        "dim_date": feed.dim_date,
    }
    references = {
        column: (column, parents[parent], field)
        for column, (parent, field) in checks.DECLARED["fct_requests"].references.items()
    }
    return quality.with_all(quality.orphan_findings(feed.fact, references), list(references))


def dq_duplicates(spark, sf):
    """Keys an extract with re-reads holds more than once."""
    rows = _with_rereads(Events(spark, sf).raw, 10)
    return quality.duplicates(rows, ["unique_key"])


def dq_reconcile(spark, sf):
    feed = Events(spark, sf)
    return checks.reconciliation(feed.fact, feed.daily)


def dq_unreconciled(spark, sf):
    """The orders reach past the calendar, so their two facts do not agree."""
    feed = Orders(spark, sf)
    return checks.unreconciled(feed.fact, feed.daily)


def dq_dropped_closures(spark, sf):
    feed = Events(spark, sf)
    return checks.dropped_closures(feed.fact, feed.daily)


def dq_unmapped_types(spark, sf):
    return checks.unmapped_types(Events(spark, sf).fact)


def dq_future_milestones(spark, sf):
    late = checks.has_future_milestone(adapters.SECOND)
    columns = ["request_id", "created_at", "closed_at", "resolution_updated_at"]
    return Events(spark, sf).fact.where(late).select(*columns)


def dq_current_versions(spark, sf):
    """Open versions per key: one each. Counted, not filtered, so the result is not empty."""
    current = _history(spark, sf).where(F.col(history.VALID_TO).isNull())
    per_key = current.groupBy("request_id").agg(F.count(F.lit(1)).alias("open_versions"))
    return per_key.groupBy("open_versions").agg(F.count(F.lit(1)).alias("requests"))


def source_freshness(spark, sf):
    feed = Events(spark, sf)
    sources = {
        "service_requests": feed.raw,
        "weather_daily": feed.raw_weather,
        "loads": feed.loads,
    }
    return checks.freshness(sources, feed.settings)


# Streams


# Event time is a zoned timestamp, which a stream reads in the session's zone.


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    source = adapters.table(spark, sf, "events")
    # A pattern, so that the table may be one file or a folder of files.
    return jobs.landing_stream(spark, f"{sf}/events.parquet*", source.schema, "parquet")


def stream_upsert(spark, sf):
    """Requests streamed, with re-reads, into the stored keyed table."""
    out = scratch_dir(spark, "stream-upsert")
    rows = _with_rereads(adapters.requests_from_events(_event_stream(spark, sf)), 10)
    with session_zone(spark):
        jobs.upsert_stream(
            rows,
            f"{out}/table",
            REQUESTS_LAYOUT,
            landing.request_version(adapters.EVENTS),
            f"{out}/checkpoint",
            landing.request_tiebreak(),
        )
    return _read(spark, f"{out}/table")


def stream_dedup(spark, sf):
    """Re-read rows dropped at the page boundary."""
    out = scratch_dir(spark, "stream-dedup")
    events = _event_stream(spark, sf)
    copies = F.when(F.col("event_id") % 10 == 0, 2).otherwise(1)
    twice = events.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")
    with session_zone(spark):
        fresh = jobs.without_rereads(twice, ["event_id", "ts"], "ts", "1 hour")
        jobs.to_files(fresh, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{out}/rows")


DEMAND_LAYOUT = tables.Layout(["service_date", "event_type"], "service_date", buckets=8)


def stream_daily_demand(spark, sf):
    """Requests per local day and type, as current as the newest row: each micro-batch hands on the
    counts it changed, which replace the stored ones by key."""
    out = scratch_dir(spark, "stream-demand")
    events = _event_stream(spark, sf)
    local = events.withColumn(
        "local_ts", F.convert_timezone(F.lit("UTC"), F.lit(adapters.EVENTS.local_tz), F.col("ts"))
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        tables.upsert_table(batch.sparkSession, f"{out}/table", batch, DEMAND_LAYOUT)

    with session_zone(spark):
        demand = jobs.daily_demand(local, "local_ts", "event_type", "2 days")
        once = jobs.applied_once(f"{out}/table", f"{out}/checkpoint", merge)
        jobs.run_available(demand, f"{out}/checkpoint", once, "update")
    return _read(spark, f"{out}/table")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        stg_requests,
        stg_weather,
        int_requests,
        int_weather_banded,
        temp_band_ladder,
        precip_band_ladder,
        snow_band_ladder,
        surrogate_keys,
        dim_date,
        dim_agency,
        dim_location,
        dim_category,
        dim_weather_band,
        fct_requests,
        fct_daily,
        fct_orders,
        orders_daily,
        agency_performance,
        daily_service_levels,
        heat_season,
        freshness,
        freshness_banner,
        citywide_daily,
        citywide_order,
        agency_rollup,
        top_agencies,
        by_borough_category,
        service_level_trend,
        agencies,
        agency_selected,
        top_selected,
        agency_totals,
        agency_by_borough,
        heat_daily,
        in_season,
        out_of_season,
        by_weather,
        snow_days,
        sketch_percentiles,
        cursor_read,
        dual_cursor,
        raw_upsert,
        raw_upsert_table,
        raw_upsert_landed,
        trailing_reload,
        payload_unpivot,
        extract_audit,
        extract_audit_edges,
        extract_manifest,
        landing_json,
        capped_landing,
        load_ledger,
        agency_sightings,
        seed_demand,
        resumable_ingest,
        additive_columns,
        clustered_sink,
        stored_extract,
        incremental_merge,
        incremental_merge_table,
        lookback_watermark,
        scd2_history,
        scd2_replayed,
        scd2_current,
        scd2_point_in_time,
        time_in_status,
        stale_open_versions,
        dq_summary,
        dq_row_checks,
        dq_relationships,
        dq_duplicates,
        dq_reconcile,
        dq_unreconciled,
        dq_dropped_closures,
        dq_unmapped_types,
        dq_future_milestones,
        dq_current_versions,
        source_freshness,
        stream_upsert,
        stream_dedup,
        stream_daily_demand,
    )
}
