"""The declared checks of every table, and the cross-table ones."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.functions import bands
from deskwise.functions.timing import MAX_PLAUSIBLE_HOURS
from deskwise.operators import quality as q
from deskwise.operators.spine import one_row
from deskwise.operators.history import SCD_ID, VALID_FROM, VALID_TO
from deskwise.plans.dimensions import LOCATIONS
from deskwise.settings import Settings

# Vocabularies and plausible ranges.
BOROUGHS = [name for name, *_, known in LOCATIONS if known]
STATUSES = [
    "Closed",
    "Open",
    "Pending",
    "In Progress",
    "Assigned",
    "Started",
    "Unspecified",
    "Email Sent",
    "Draft",
    "Closed - Testing",
]
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]
LATITUDES = (40.4, 41.0)
LONGITUDES = (-74.3, -73.6)
HOURS = (0, MAX_PLAUSIBLE_HOURS)
NOT_NEGATIVE = (0, None)

# Complaint types unmapped, and future milestones, that are still tolerated.
MAX_UNMAPPED_TYPES = 10000
MAX_FUTURE_MILESTONES = 10


@dataclass(frozen=True)
class TableChecks:
    not_null: tuple[str, ...] = ()
    # Required only where the flag column holds.
    not_null_where: Mapping[str, str] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    unique_together: tuple[str, ...] = ()
    accepted: Mapping[str, list[str]] = field(default_factory=dict)
    between: Mapping[str, tuple] = field(default_factory=dict)
    # Column -> (parent table, parent column).
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # Columns whose accepted/between check only warns.
    lenient: tuple[str, ...] = ()

    @property
    def count(self) -> int:
        single = (self.not_null, self.not_null_where, self.unique, self.accepted, self.between)
        return sum(map(len, single)) + len(self.references) + bool(self.unique_together)


DECLARED: dict[str, TableChecks] = {
    "service_requests": TableChecks(
        not_null=("unique_key", "created_date"),
        unique=("unique_key",),
    ),
    "weather_daily": TableChecks(not_null=("observed_on",), unique=("observed_on",)),
    "loads": TableChecks(not_null=("load_id", "status"), unique=("load_id",)),
    "seed": TableChecks(
        not_null=(
            "complaint_type",
            "service_category",
            "service_subcategory",
            "is_weather_sensitive",
        ),
        unique=("complaint_type",),
    ),
    "stg_requests": TableChecks(
        not_null=("request_id", "created_at"),
        unique=("request_id",),
        accepted={"borough_name": BOROUGHS},
        between={"latitude": LATITUDES, "longitude": LONGITUDES},
        lenient=("borough_name", "latitude", "longitude"),
    ),
    "stg_weather": TableChecks(
        not_null=("weather_date",),
        unique=("weather_date",),
        between={"temp_mean_f": (-20, 115), "precipitation_in": (0, 20)},
    ),
    "int_weather_banded": TableChecks(
        not_null=("weather_date", "weather_band_key", "temp_band", "precip_band", "snow_band"),
        unique=("weather_date",),
        references={"weather_band_key": ("dim_weather_band", "weather_band_key")},
    ),
    "int_requests": TableChecks(
        not_null=(
            "request_id",
            "created_at",
            "created_date_local",
            "service_category",
            "service_subcategory",
            "is_weather_sensitive",
            "is_unmapped_complaint_type",
            "is_closed",
            "is_implausible_resolution",
        ),
        unique=("request_id",),
        between={"resolution_hours": (-8760, 200000)},
    ),
    "dim_date": TableChecks(
        not_null=(
            "date_key",
            "is_heat_season",
            "season",
            "is_weekend",
            "day_of_week",
            "calendar_year",
            "month_start_date",
            "week_start_date",
        ),
        unique=("date_key",),
        accepted={"season": SEASONS},
        between={"day_of_week": (1, 7)},
    ),
    "dim_category": TableChecks(
        not_null=(
            "complaint_category_key",
            "complaint_type",
            "service_category",
            "service_subcategory",
            "is_weather_sensitive",
        ),
        unique=("complaint_category_key", "complaint_type"),
    ),
    "dim_agency": TableChecks(
        not_null=("agency_key", "agency_code", "agency_name", "is_known_agency"),
        unique=("agency_key", "agency_code"),
    ),
    "dim_location": TableChecks(
        not_null=("location_key", "borough_name", "borough_label", "is_known_borough"),
        not_null_where={"county_name": "is_known_borough", "county_fips": "is_known_borough"},
        unique=("location_key", "borough_name", "borough_label"),
        accepted={"borough_name": [name for name, *_ in LOCATIONS]},
    ),
    "dim_weather_band": TableChecks(
        not_null=(
            "weather_band_key",
            "temp_band",
            "precip_band",
            "snow_band",
            "weather_band_label",
            "is_temperature_extreme",
            "is_severe_precipitation",
        ),
        unique=("weather_band_key",),
        accepted={
            "temp_band": bands.TEMPERATURE.members,
            "precip_band": bands.PRECIPITATION.members,
            "snow_band": bands.SNOW.members,
        },
    ),
    "fct_requests": TableChecks(
        not_null=(
            "request_id",
            "created_at",
            "complaint_category_key",
            "agency_key",
            "location_key",
            "weather_band_key",
            "created_date_local",
            "is_closed",
            "is_implausible_resolution",
            "is_weather_sensitive",
            "is_unmapped_complaint_type",
            "borough_name",
            "service_category",
            "agency_code",
            "status",
        ),
        unique=("request_id",),
        accepted={"status": STATUSES},
        between={"reportable_resolution_hours": HOURS},
        references={
            "complaint_category_key": ("dim_category", "complaint_category_key"),
            "agency_key": ("dim_agency", "agency_key"),
            "location_key": ("dim_location", "location_key"),
            "weather_band_key": ("dim_weather_band", "weather_band_key"),
            "created_date_local": ("dim_date", "date_key"),
            "borough_name": ("dim_location", "borough_name"),
            "service_category": ("dim_category", "service_category"),
        },
        lenient=("status",),
    ),
    "fct_daily": TableChecks(
        not_null=(
            "daily_service_level_key",
            "service_date",
            "requests_created",
            "borough_name",
            "service_category",
            "location_key",
            "weather_band_key",
            "requests_closed",
            "closed_within_1_day",
            "closed_within_3_days",
            "closures_measured",
        ),
        unique=("daily_service_level_key",),
        unique_together=("service_date", "borough_name", "service_category"),
        between={
            "requests_created": NOT_NEGATIVE,
            "requests_closed": NOT_NEGATIVE,
            "closed_within_1_day": NOT_NEGATIVE,
            "closed_within_3_days": NOT_NEGATIVE,
            "closures_measured": NOT_NEGATIVE,
            "pct_closed_within_3_days": (0, 1),
            "avg_resolution_hours": HOURS,
            "median_resolution_hours": HOURS,
            "p90_resolution_hours": HOURS,
        },
        references={
            "location_key": ("dim_location", "location_key"),
            "weather_band_key": ("dim_weather_band", "weather_band_key"),
        },
    ),
    "snp_request_status": TableChecks(
        not_null=(SCD_ID, "request_id", "status", VALID_FROM),
        unique=(SCD_ID,),
        unique_together=("request_id", VALID_FROM),
    ),
}

# Source, time column and age limits.
FRESHNESS = {
    "service_requests": ("created_date", q.Freshness(timedelta(days=3), timedelta(days=7))),
    "weather_daily": ("observed_on", q.Freshness(timedelta(days=8), timedelta(days=14))),
    "loads": ("inserted_at", q.Freshness(timedelta(hours=36), timedelta(hours=72))),
}


# Cross-column rules: predicates that hold for failing rows, fused with the declared ones.


def closure_is_inconsistent():
    """Closed without closing time or measure, or open with either."""
    has = [F.col("closed_at").isNotNull(), F.col("resolution_hours").isNotNull()]
    return F.when(F.col("is_closed"), ~(has[0] & has[1])).otherwise(has[0] | has[1])


def has_future_milestone(settings: Settings):
    milestones = [F.col(c) > settings.now for c in ("created_at", "closed_at", "resolution_updated_at")]
    return reduce(lambda a, b: a | b, milestones)


def counters_do_not_nest():
    chain = ["closed_within_1_day", "closed_within_3_days", "closures_measured", "requests_closed"]
    return reduce(
        lambda a, b: a | b, [F.col(a) > F.col(b) for a, b in zip(chain, chain[1:], strict=False)]
    )


def heat_season_is_wrong():
    """Against the statute itself: the season is every day but June 1 to September 30."""
    summer = F.date_format("date_key", "MM-dd").between("06-01", "09-30")
    return F.col("is_heat_season") == summer


def row_rules(table: str, settings: Settings) -> dict:
    rules = {
        "fct_requests": {
            "fct_requests.closed_has_resolution": closure_is_inconsistent(),
            "fct_requests.no_future_milestones": has_future_milestone(settings),
        },
        "fct_daily": {"fct_daily.counters_nest": counters_do_not_nest()},
        "dim_date": {"dim_date.heat_season_matches_statute": heat_season_is_wrong()},
    }
    return rules.get(table, {})


# Cross-row and cross-table rules, as queries for failing rows.


def unmapped_types(fact: DataFrame) -> DataFrame:
    return (
        fact.where("is_unmapped_complaint_type")
        .groupBy("complaint_type")
        .agg(F.count(F.lit(1)).alias("unmapped_requests"))
    )


def reconciliation(fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Totals of the two facts side by side, one row."""
    dated = fact.where(F.col("created_date_local").isNotNull())
    return one_row(fact.sparkSession).select(
        dated.agg(F.count(F.lit(1))).scalar().alias("request_count"),
        daily.agg(F.sum("requests_created")).scalar().alias("daily_count"),
    )


def unreconciled(fact: DataFrame, daily: DataFrame) -> DataFrame:
    return reconciliation(fact, daily).where(F.col("request_count") != F.col("daily_count"))


def dropped_closures(fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Closures that fall on days past the last created day, which the daily spine leaves out."""
    closed = fact.where(F.col("is_closed") & F.col("closed_date_local").isNotNull())
    return one_row(fact.sparkSession).select(
        closed.agg(F.count(F.lit(1))).scalar().alias("closures"),
        daily.agg(F.coalesce(F.sum("requests_closed"), F.lit(0))).scalar().alias("daily_closures"),
    ).withColumn("dropped", F.col("closures") - F.col("daily_closures"))


def open_version_conflicts(history: DataFrame) -> DataFrame:
    return q.duplicates(history.where(F.col(VALID_TO).isNull()), ["request_id"])


# Running the suite


def predicates(table: str, checks: TableChecks, settings: Settings) -> dict:
    """Every row-level check of a table, by name."""
    named = {f"{table}.{c}.not_null": q.is_missing(c) for c in checks.not_null}
    for column, flag in checks.not_null_where.items():
        named[f"{table}.{column}.not_null"] = q.is_missing(column, F.col(flag))
    for column, values in checks.accepted.items():
        named[f"{table}.{column}.accepted_values"] = q.not_accepted(column, values)
    for column, (low, high) in checks.between.items():
        named[f"{table}.{column}.between"] = q.out_of_range(column, low, high)
    return {**named, **row_rules(table, settings)}


def limits() -> dict[str, q.Limits]:
    """Checks that do not simply error on any failure."""
    named = {
        f"{table}.{column}.{kind}": q.WARN_ON_ANY
        for table, checks in DECLARED.items()
        for kind, columns in (("accepted_values", checks.accepted), ("between", checks.between))
        for column in columns
        if column in checks.lenient
    }
    return {
        **named,
        "fct_requests.types_are_mapped": q.Limits(0, MAX_UNMAPPED_TYPES),
        "fct_requests.no_future_milestones": q.Limits(MAX_FUTURE_MILESTONES, None),
    }


def unique_sets(table: str, checks: TableChecks) -> dict[str, list[str]]:
    named = {f"{table}.{c}.unique": [c] for c in checks.unique}
    if checks.unique_together:
        named[f"{table}.unique_together"] = list(checks.unique_together)
    return named


def foreign_keys(table: str, checks: TableChecks, tables: Mapping[str, DataFrame]) -> dict:
    return {
        f"{table}.{column}.references": (column, tables[parent], field)
        for column, (parent, field) in checks.references.items()
        if parent in tables
    }


# The table after which each cross-table check can be made.
CROSS = {
    "fct_requests": "fct_requests.types_are_mapped",
    "fct_daily": "fct_daily.reconciles_to_requests",
    "snp_request_status": "snp_request_status.one_current_version",
}


def cross_findings(table: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Cross-row and cross-table checks that belong to a table, by name."""
    if table == "fct_requests":
        failing = unmapped_types(tables[table])
    elif table == "fct_daily" and "fct_requests" in tables:
        failing = unreconciled(tables["fct_requests"], tables[table])
    elif table == "snp_request_status":
        failing = open_version_conflicts(tables[table])
    else:
        return {}
    return {CROSS[table]: q.findings_of(failing, CROSS[table])}


def row_terms(table: str, settings: Settings) -> q.RowTerms:
    """The row checks of a table, to be counted while it is written."""
    return q.RowTerms(predicates(table, DECLARED[table], settings) if table in DECLARED else {})


def names_of(table: str, tables: Mapping[str, DataFrame], settings: Settings) -> list[str]:
    """Every check of a table, given the tables it can refer to."""
    if table not in DECLARED:
        return []
    checks = DECLARED[table]
    cross = [CROSS[table]] if table in CROSS and (table != "fct_daily" or "fct_requests" in tables) else []
    return [
        *predicates(table, checks, settings), *unique_sets(table, checks), *foreign_keys(table, checks, tables), *cross
    ]


def table_findings(
    table: str, tables: Mapping[str, DataFrame], settings: Settings, counted: Mapping[str, q.RowTerms] | None = None
) -> list[DataFrame]:
    """Findings of a table's checks. It is scanned at most three times however many there are: one fused
    aggregate for its rows, unless they were counted as it was written, one for its unique keys and one for
    its foreign keys."""
    rows, checks = tables[table], DECLARED[table]
    if table in (counted or {}):
        found = [counted[table].findings(rows.sparkSession)]
    else:
        found = [q.row_findings(rows, predicates(table, checks, settings))]
    sets, keys = unique_sets(table, checks), foreign_keys(table, checks, tables)
    if sets:
        found.append(q.unique_findings(rows, sets))
    if keys:
        found.append(q.orphan_findings(rows, keys))
    return [*found, *cross_findings(table, tables).values()]


def run_checks(
    tables: Mapping[str, DataFrame], settings: Settings, counted: Mapping[str, q.RowTerms] | None = None,
    only: str | None = None,
) -> DataFrame:
    """Check name, failing rows and outcome, for every check of the tables given, or of one of them."""
    names, found = [], []
    for table in ([only] if only else tables):
        if table in DECLARED:
            found += table_findings(table, tables, settings, counted)
            names += names_of(table, tables, settings)
    return q.judged(reduce(DataFrame.unionByName, found), names, limits())


def freshness(tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    sources = {
        name: (tables[name], F.col(column), age)
        for name, (column, age) in FRESHNESS.items()
        if name in tables
    }
    spark = next(iter(tables.values())).sparkSession
    return q.source_freshness(spark, sources, settings)
