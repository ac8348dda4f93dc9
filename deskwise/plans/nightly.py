"""The nightly job: land, audit, build model by model, check each, report.

Each layer's builders are plain functions; staging and intermediate models stay lazy, so a mart is one
Catalyst plan from the raw table. Marts are stored, and later marts read the stored ones. Every model is
checked before anything is built on it: one whose checks err stops what descends from it, and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskwise.operators.quality import ERROR, SKIPPED
from deskwise.operators.upsert import lookback_start, moved_since
from deskwise.plans import checks, dimensions, facts, intermediate, reports, staging
from deskwise.settings import RunPlan, Settings, instant
from deskwise.sources import audit, landing, ledger, schemas
from deskwise.sources.tables import (
    MONTH,
    WIDTH,
    Layout,
    Model,
    Snapshot,
    Warehouse,
    append_rows,
    materialise,
    overwrite_table,
    read_current,
    read_history,
    read_table,
    shuffle_width,
    without_parts,
)

RAW, MARTS, REPORTS, CHECKS = "raw", "marts", "reports", "checks"

# Hash buckets of a month: what the change of one row rewrites.
BUCKETS = 8
REQUESTS_LAYOUT = Layout(["unique_key"], "created_date", ["borough", "complaint_type"], BUCKETS)
WEATHER_LAYOUT = Layout(["observed_on"], "observed_on")
FACT_LAYOUT = Layout(["request_id"], "created_date_local", ["borough_name", "service_category"], BUCKETS)
DAILY_LAYOUT = Layout(["daily_service_level_key"], "service_date", ["borough_name", "service_category"])
STATUS = Snapshot("request_id", "status_changed_at", ("status",), buckets=BUCKETS)


class ChecksFailed(RuntimeError):
    """Checks of a run with the outcome ``error``. What descends from their models was not built and is as
    the last good run left it."""

    def __init__(self, names: list[str]):
        super().__init__(", ".join(names))
        self.names = names


class ExtractIncomplete(RuntimeError):
    """The landed chunks do not join up. Nothing of them was merged, and no file counts as taken."""

    def __init__(self, findings: list[str]):
        super().__init__("; ".join(findings))
        self.findings = findings


@dataclass(frozen=True)
class Step:
    """A model of the run: what it is built from, how, and how it is kept. Without ``build`` it is a source
    that has landed."""

    name: str
    needs: tuple[str, ...] = ()
    build: Callable[[Job, dict[str, DataFrame]], DataFrame] | None = None
    model: Model = field(default_factory=lambda: Model("ephemeral"))
    layer: str = MARTS


def _table(layout: Layout | None = None) -> Model:
    return Model("table", layout)


@dataclass(frozen=True)
class Job:
    spark: SparkSession
    warehouse: Warehouse
    settings: Settings

    def path(self, layer: str, name: str) -> str:
        return self.warehouse.path(layer, name)

    def read(self, layer: str, name: str, from_month: str | None = None) -> DataFrame | None:
        """A stored table; ``from_month`` leaves the folders of older months unread."""
        if (layer, name) == (MARTS, "snp_request_status"):
            return read_history(self.spark, self.path(layer, name))
        rows = read_table(self.spark, self.path(layer, name), self.warehouse.name(layer, name))
        if rows is not None and MONTH in rows.columns and from_month is not None:
            rows = rows.where(F.col(MONTH) >= from_month)
        return without_parts(rows)

    @contextmanager
    def widened(self):
        """Shuffles sized by the largest stored tables, for the length of a run."""
        before = self.spark.conf.get(WIDTH, None)
        stored = [self.path(RAW, "service_requests"), self.path(MARTS, "fct_requests")]
        self.spark.conf.set(WIDTH, str(shuffle_width(self.spark, stored)))
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(WIDTH)
            else:
                self.spark.conf.set(WIDTH, before)

    # Landing

    def land_requests(
        self, paths: str | list[str], load_id: str, backfill: bool = False, walks: DataFrame | None = None
    ) -> int:
        """Requests of files that no run has taken yet, merged into the raw table by key; at most
        ``max_chunks_per_run`` files. Returns how many.

        A file is taken whole: what of it is older than the feeds' first reach is left out, but nothing for
        being behind a cursor, as a capped run may have read newer files before. Numbered chunks are
        audited before anything is merged; ``walks`` (walk, first_no, last_no), if given, also tells which
        chunks there must be, which is checked when no file is left. Data come first, then the ledger,
        the files and the cursors, so a run that dies takes its files again.
        """
        spark, taken_path = self.spark, self.path(RAW, "landed_files")
        taken = read_table(spark, taken_path)
        cap = self.settings.max_chunks_per_run
        files = landing.files_to_take(landing.landed_files(spark, paths), taken, cap)
        # As many as the cap; without one, what has landed since the last run.
        rows = files.collect()
        if not rows:
            self._expect(walks)
            self._commit(load_id)
            return 0
        files = spark.createDataFrame([(*r, load_id) for r in rows], schemas.LANDED_FILES)
        size = sum(r["length"] for r in rows)
        landed = landing.typed_requests(landing.read_files(spark, [r["path"] for r in rows], size))
        chunks = self._audit(landed, walks if not cap or len(rows) < cap else None)
        read = landing.changed_requests(landed, self.settings, None, backfill)
        batch = read.withColumn(schemas.LOAD_ID, F.lit(load_id))
        inside = [landing.request_version(self.settings).desc_nulls_last(), *landing.request_tiebreak()]
        # The cursors to commit are noted while the rows are merged.
        wanted = [landing.CREATED] if backfill else [landing.CREATED, landing.UPDATED]
        seen = Observation()
        merged = batch.observe(
            seen, *[F.max(F.when(F.col(c) <= self.settings.now, F.col(c))).alias(c) for c in wanted]
        )
        self._merge_raw("service_requests", merged, REQUESTS_LAYOUT, landing.landing_version(), inside)
        self._note_sightings(batch, backfill)
        self._commit(load_id)
        if chunks is not None:
            append_rows(chunks, self.path(RAW, "chunks"))
        append_rows(files, taken_path)
        newest = seen.get
        for column in wanted:
            if newest[column] is not None:
                state = self.path(RAW, "cursors")
                ledger.commit_cursor(spark, state, column, newest[column], self.settings.as_of)
        return len(rows)

    def _audit(self, landed: DataFrame, walks: DataFrame | None) -> DataFrame | None:
        """Summaries of the numbered chunks, which must join up with each other and with what has landed
        before; None without any."""
        walk = F.regexp_extract(landing.LANDED_FILE, landing.CHUNK_FILE, 1)
        number = F.regexp_extract(landing.LANDED_FILE, landing.CHUNK_FILE, 2)
        cursor = F.when(walk.startswith("updated"), F.col(landing.UPDATED)).otherwise(F.col(landing.CREATED))
        numbered = landed.select(walk.alias("walk"), number.try_cast("bigint").alias("chunk_no"), cursor.alias("cursor"))
        # A row per chunk that this run takes.
        found = audit.chunk_summary(numbered.where(F.col("chunk_no").isNotNull()), "cursor")
        summary = self.spark.createDataFrame(found.collect(), found.schema)
        if summary.isEmpty():
            self._expect(walks)
            return None
        before = read_table(self.spark, self.path(RAW, "chunks"))
        together = audit.continued(summary, before)
        self._refuse(audit.summary_findings(together).select("walk", "chunk_no", "finding"))
        self._expect(walks, summary if before is None else before.unionByName(summary))
        return summary

    def _expect(self, walks: DataFrame | None, chunks: DataFrame | None = None) -> None:
        if walks is None:
            return
        if chunks is None:
            chunks = read_table(self.spark, self.path(RAW, "chunks"))
        if chunks is None:
            chunks = self.spark.createDataFrame([], "walk string, chunk_no bigint")
        self._refuse(audit.edge_findings(chunks, walks).select("walk", "expected_no", "finding"))

    def _refuse(self, findings: DataFrame) -> None:
        # A finding is one chunk of a run that must not go on.
        found = sorted(tuple(r) for r in findings.limit(100).collect())
        if found:
            raise ExtractIncomplete([f"{walk}-{number}: {what}" for walk, number, what in found])

    def land_weather(self, payloads: DataFrame, body: str, load_id: str, backfill: bool = False) -> None:
        """The trailing window of observations, replacing the stored days."""
        days = landing.unpivot_payload(payloads, body, instant(self.settings.as_of))
        window = landing.trailing_observations(days, self.settings, backfill)
        batch = window.withColumn(schemas.LOAD_ID, F.lit(load_id))
        among_equals = [F.col(v).desc_nulls_last() for v in schemas.WEATHER_VARIABLES]
        self._merge_raw("weather_daily", batch, WEATHER_LAYOUT, F.col("_extracted_at"), among_equals)
        self._commit(load_id)

    def _merge_raw(
        self, table: str, batch: DataFrame, layout: Layout, version: Column, tiebreak: list[Column]
    ) -> None:
        model = Model("incremental", layout, version=version, tiebreak=tuple(tiebreak))
        materialise(model, batch, self.warehouse.name(RAW, table), self.path(RAW, table))

    def _note_sightings(self, batch: DataFrame, backfill: bool) -> None:
        """Keep up what the agency dimension is made of, so that no run reads all requests for it. A name
        that was corrected since stays known until the next backfill, which starts from the raw table."""
        path = self.path(RAW, "agency_sightings")
        before = None if backfill else read_table(self.spark, path)
        if before is None:
            seen = dimensions.agency_sightings(staging.stg_requests(self.read(RAW, "service_requests")))
        else:
            seen = dimensions.later_sightings(before, dimensions.agency_sightings(staging.stg_requests(batch)))
        overwrite_table(seen, path)

    def _commit(self, load_id: str) -> None:
        ledger.record_load(self.spark, self.path(RAW, "loads"), load_id, self.settings.as_of)

    # Models

    def build(self, seed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
        """Every model in order, each checked before what needs it is built. Returns the models by name,
        those kept in tables read back, and the outcomes of all checks, which are stored as well."""
        spark, models, results = self.spark, {"seed": seed}, []
        stopped: set[str] = set()
        for step in STEPS:
            if stopped.intersection(step.needs):
                stopped.add(step.name)
                # As many names as the model has declared checks.
                names = checks.names_of(step.name, dict.fromkeys(s.name for s in STEPS), self.settings)
                results += [(n, None, SKIPPED) for n in names]
                continue
            counted = {}
            if step.build is not None:
                rows = step.build(self, models)
                if step.model.kind == "table":
                    counted = {step.name: checks.row_terms(step.name, self.settings)}
                    rows = counted[step.name].attach(rows)
                name = step.name if step.model.kind == "view" else self.warehouse.name(step.layer, step.name)
                models[step.name] = materialise(step.model, rows, name, self.path(step.layer, step.name))
            elif step.name != "seed":
                models[step.name] = self._source(step.name)
            if step.name in checks.DECLARED:
                found = checks.run_checks(models, self.settings, counted, step.name).collect()
                results += [tuple(r) for r in found]
                if any(r["outcome"] == ERROR for r in found):
                    stopped.add(step.name)
        outcomes = spark.createDataFrame(results, "check_name string, failures bigint, outcome string")
        overwrite_table(outcomes, self.path(CHECKS, "results"))
        overwrite_table(checks.freshness(models, self.settings), self.path(CHECKS, "freshness"))
        return models, self.read(CHECKS, "results")

    def _source(self, name: str) -> DataFrame:
        if name == "loads":
            return ledger.read_loads(self.spark, self.path(RAW, name))
        return self.read(RAW, name)

    def fresh_requests(self, models: dict[str, DataFrame]) -> DataFrame:
        """What the lifecycle fact has to merge: all of the window at first, then what moved since.

        The raw months before the window are not read, and the watermark is taken as a value, so it
        reaches the raw scan as a plain filter.
        """
        settings, moment = self.settings, ("resolution_updated_at", "created_at")
        first_month = settings.window_start.strftime("%Y-%m")
        staged = staging.stg_requests(self.read(RAW, "service_requests", first_month))
        target = self.read(MARTS, "fct_requests")
        start = None if target is None else lookback_start(target, *moment, settings)
        if start is not None:
            staged = staged.where(moved_since(*moment, instant(start)))
        return facts.fct_requests(
            intermediate.int_requests(staged, models["seed"], settings),
            models["int_weather_banded"],
            models["dim_date"],
            settings,
        )

    def current_status(self) -> DataFrame | None:
        """The open version of each tracked request."""
        return read_current(self.spark, self.path(MARTS, "snp_request_status"))


# What is built, in order, and on what. A model comes behind those its checks refer to.
STEPS = (
    Step("service_requests"),
    Step("weather_daily"),
    Step("loads"),
    Step("seed"),
    Step("dim_date", (), lambda job, m: dimensions.dim_date(job.spark, job.settings), _table()),
    Step("dim_location", (), lambda job, m: dimensions.dim_location(job.spark), _table()),
    Step("dim_category", ("seed",), lambda job, m: dimensions.dim_category(m["seed"]), _table()),
    Step("dim_weather_band", (), lambda job, m: dimensions.dim_weather_band(job.spark), _table()),
    Step("stg_requests", ("service_requests",), lambda job, m: staging.stg_requests(m["service_requests"])),
    Step("stg_weather", ("weather_daily",), lambda job, m: staging.stg_weather(m["weather_daily"])),
    Step("int_requests", ("stg_requests", "seed"),
         lambda job, m: intermediate.int_requests(m["stg_requests"], m["seed"], job.settings)),
    Step("int_weather_banded", ("stg_weather",), lambda job, m: intermediate.int_weather_banded(m["stg_weather"])),
    Step("dim_agency", ("stg_requests",),
         lambda job, m: dimensions.agencies_of(job.read(RAW, "agency_sightings")), _table()),
    Step("fct_requests",
         ("int_requests", "int_weather_banded", "dim_date", "dim_location", "dim_category", "dim_weather_band", "dim_agency"),
         lambda job, m: job.fresh_requests(m), Model("incremental", FACT_LAYOUT)),
    Step("fct_daily", ("fct_requests",),
         lambda job, m: facts.fct_daily(m["fct_requests"], m["dim_date"], m["dim_location"], m["dim_category"], m["int_weather_banded"]),
         _table(DAILY_LAYOUT)),
    Step("snp_request_status", ("stg_requests",),
         lambda job, m: facts.snapshot_source(m["stg_requests"], job.settings), Model("snapshot", snapshot=STATUS)),
    Step("agency_performance", ("fct_requests", "dim_agency"),
         lambda job, m: reports.agency_performance(m["fct_requests"], m["dim_agency"]), _table(), REPORTS),
    Step("daily_service_levels", ("fct_daily",), lambda job, m: reports.daily_extract(m["fct_daily"]), _table(), REPORTS),
    Step("heat_season", ("fct_daily", "dim_date"),
         lambda job, m: reports.heat_season(m["dim_date"], m["fct_requests"], m["fct_daily"]), _table(), REPORTS),
    Step("pipeline_freshness", ("loads", "fct_requests"),
         lambda job, m: reports.pipeline_freshness(m["loads"], m["fct_requests"], job.settings), _table(), REPORTS),
)


def run_nightly(
    job: Job,
    plan: RunPlan,
    request_paths: str | list[str],
    weather_payloads: DataFrame,
    weather_body: str,
    seed: DataFrame,
    walks: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """One run end to end. A lost chunk of the landing raises ``ExtractIncomplete`` before anything is
    merged; any other failure propagates before that feed's files and cursor are committed. A check that
    errs raises ``ChecksFailed`` after all models that do not descend from it are built."""
    stamp = job.settings.as_of.strftime("%Y%m%d%H%M%S")
    with job.widened():
        if "requests" in plan.sources:
            job.land_requests(request_paths, f"requests-{stamp}", plan.backfill, walks)
        if "weather" in plan.sources:
            job.land_weather(weather_payloads, weather_body, f"weather-{stamp}", plan.backfill)
    with job.widened():
        models, outcomes = job.build(seed)
    # As many rows as there are declared checks.
    failed = outcomes.where(F.col("outcome") == ERROR).select("check_name").orderBy("check_name").collect()
    if failed:
        raise ChecksFailed([r["check_name"] for r in failed])
    return {**models, "checks": outcomes, "freshness": job.read(CHECKS, "freshness")}
