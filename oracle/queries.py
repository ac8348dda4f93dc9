"""One DuckDB statement per registered query."""

from __future__ import annotations

from deskwise.plans.checks import DECLARED
from oracle.tables import STAMP, ladder, md5_key, statement

# The landed fields.
RAW_COLUMNS = (
    "unique_key, created_date, closed_date, resolution_action_updated_date, agency, agency_name, "
    "complaint_type, descriptor, location_type, incident_zip, borough, status, "
    "open_data_channel_type, latitude, longitude"
)
PERF_TOTALS = """sum(requests_total)::bigint as requests_total, sum(requests_open)::bigint as requests_open"""
MEAN_HOURS = """round(sum(avg_resolution_hours * closures_measured) / nullif(sum(closures_measured), 0), 6)
  as avg_resolution_hours"""
SHARE = "sum(closed_within_3_days) / nullif(sum(closures_measured), 0) as pct_closed_within_3_days"


def readings(band: str, kind: str, value: str) -> str:
    reading = f"case when event_id % 17 <> 0 then {value} end"
    return f"""select {ladder(kind, 'v')} as {band}, count(*) as readings
    from (select {reading} as v from events) group by 1"""


def demand(dimension: str, key: str, fact_key: str | None = None) -> str:
    return f"""select d.*, (select count(*) from ev_fact f where f.{fact_key or key} = d.{key}) as requests_created
    from {dimension} d"""


FRESHNESS = """select
  (select max(inserted_at) from ev_loads where status = 0) as last_load_at,
  (select count(*) from ev_loads where status = 0) as loads_total,
  max(created_at) as latest_request_at, count(*) as requests_total,
  timestamp '2024-02-01' as built_at from ev_fact"""

BANNER = f"""select last_load_at, latest_request_at, requests_total,
  (date '2024-02-01' - latest_request_at::date)::int as days_behind,
  case when date '2024-02-01' - latest_request_at::date > 4 then 'warning' else 'info' end as banner_status
  from ({FRESHNESS})"""

ROLLUP = f"""select agency_code, agency_name, sum(requests_total)::bigint as requests_total,
  sum(closures_measured)::bigint as closures_measured, {SHARE}, {MEAN_HOURS}
  from ev_perf group by all having sum(requests_total) > 1000
  order by requests_total desc, agency_code"""

SELECTED = f"""select borough_name, service_category, {PERF_TOTALS},
  sum(closures_measured)::bigint as closures_measured, {MEAN_HOURS}, {SHARE}
  from ev_perf where agency_code = 'A1' group by all having sum(requests_total) > 50
  order by requests_total desc, borough_name, service_category"""


def by_temperature(flag: str) -> str:
    return f"""select round(temp_mean_f / 5) * 5 as temp_bucket, avg(heat_requests) as avg_heat_requests,
    count(*) as days from oa_heat where {flag} and temp_mean_f is not null
    group by 1 having count(*) > 4"""


CHANGED = """select * from x2_raw where created_date >= timestamp '2024-01-25'
  or resolution_action_updated_date >= timestamp '2024-01-20'"""

UPSERTED = f"""with c as ({CHANGED})
  from c union all by name from x1_raw where unique_key not in (select unique_key from c)"""

CHUNKS = """select event_type as walk, event_id // 16 as chunk_no, date_trunc('hour', ts) as cursor
  from events"""

AUDIT = f"""with s as (
    select walk, chunk_no, min(cursor) as first_cursor, max(cursor) as last_cursor, count(*) as rows
    from ({CHUNKS}) group by all),
  p as (select s.*, q.last_cursor as previous_last, min(s.chunk_no) over (partition by s.walk) as first_no,
      max(s.last_cursor) over (partition by s.walk) as walk_end
    from s left join s q on q.walk = s.walk and q.chunk_no = s.chunk_no - 1)
  select walk, chunk_no, finding, first_cursor, last_cursor, previous_last, rows from (
    select *, case when previous_last is null and chunk_no > first_no then 'missing_before'
      when first_cursor > previous_last then 'gap'
      when last_cursor <= previous_last and last_cursor < walk_end then 'stalled' end as finding from p)
  where finding is not null"""

HIST = "select * from hist"


# A sketch is right if the rank of what it returns is close enough: here only the exact values are compared.
SKETCHES = """select borough_name, service_category, date_trunc('month', closed_date_local)::date as month,
    count(reportable_resolution_hours) as closures_measured,
    quantile_disc(reportable_resolution_hours, 0.5) as median_resolution_hours,
    quantile_disc(reportable_resolution_hours, 0.9) as p90_resolution_hours,
    true as median_within_bound, true as p90_within_bound
  from ev_fact where closed_date_local is not null and reportable_resolution_hours is not null group by all"""

# Checks

TABLE_OF = {
    "service_requests": "ev_raw",
    "weather_daily": "ev_wx_raw",
    "loads": "ev_loads",
    "seed": "ev_seed",
    "stg_requests": "ev_stg",
    "stg_weather": "ev_wx_stg",
    "int_weather_banded": "ev_wx",
    "int_requests": "ev_int",
    "dim_date": "ev_cal",
    "dim_category": "ev_cat",
    "dim_agency": "ev_agency",
    "dim_location": "loc",
    "dim_weather_band": "bands",
    "fct_requests": "ev_fact",
    "fct_daily": "ev_daily",
    "snp_request_status": "hist",
}
FUTURE = " or ".join(
    f"coalesce({c} > timestamp '2024-01-30', false)" for c in ("created_at", "closed_at", "resolution_updated_at")
)
ROW_RULES = {
    "fct_requests.closed_has_resolution": "is_closed <> (closed_at is not null) "
    "or is_closed <> (resolution_hours is not null)",
    "fct_requests.no_future_milestones": FUTURE,
    "fct_daily.counters_nest": "closed_within_1_day > closed_within_3_days "
    "or closed_within_3_days > closures_measured or closures_measured > requests_closed",
    "dim_date.heat_season_matches_statute": "is_heat_season <> (month(date_key) >= 10 or month(date_key) <= 5)",
}


def row_terms(table: str) -> dict[str, str]:
    checks = DECLARED[table]
    terms = {f"{table}.{c}.not_null": f"{c} is null" for c in checks.not_null}
    terms |= {f"{table}.{c}.not_null": f"{c} is null and {w}" for c, w in checks.not_null_where.items()}
    for c, values in checks.accepted.items():
        terms[f"{table}.{c}.accepted_values"] = f"{c} not in ({', '.join(repr(v) for v in values)})"
    for c, (low, high) in checks.between.items():
        bounds = [f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None)
        terms[f"{table}.{c}.between"] = " or ".join(bounds)
    return terms | {k: v for k, v in ROW_RULES.items() if k.startswith(f"{table}.")}


def count_terms(table: str) -> str:
    terms = row_terms(table)
    aggregates = ", ".join(f'count(*) filter ({t}) as "{n}"' for n, t in terms.items())
    names = ", ".join(f'"{n}"' for n in terms)
    return f"""select check_name, failures from (select {aggregates} from {TABLE_OF[table]})
    unpivot (failures for check_name in ({names}))"""


def count_rows(name: str, select: str) -> str:
    return f"select '{name}' as check_name, count(*) as failures from ({select})"


def orphans(child: str, column: str, parent: str, field: str) -> str:
    return f"select 1 from {child} where {column} is not null and {column} not in (select {field} from {parent})"


def all_findings() -> str:
    found = []
    for table, checks in DECLARED.items():
        source = TABLE_OF[table]
        found.append(count_terms(table))
        for c in checks.unique:
            dupes = f"select {c} from {source} where {c} is not null group by 1 having count(*) > 1"
            found.append(count_rows(f"{table}.{c}.unique", dupes))
        if checks.unique_together:
            keys = ", ".join(checks.unique_together)
            dupes = f"select {keys} from {source} group by all having count(*) > 1"
            found.append(count_rows(f"{table}.unique_together", dupes))
        for c, (parent, field) in checks.references.items():
            lost = orphans(source, c, TABLE_OF[parent], field)
            found.append(count_rows(f"{table}.{c}.references", lost))
    found.append(
        count_rows(
            "fct_requests.types_are_mapped",
            "select distinct complaint_type from ev_fact where is_unmapped_complaint_type",
        )
    )
    found.append(
        count_rows(
            "fct_daily.reconciles_to_requests",
            "select 1 where (select count(*) from ev_fact) <> (select sum(requests_created) from ev_daily)",
        )
    )
    found.append(
        count_rows(
            "snp_request_status.one_current_version",
            "select request_id from hist where dbt_valid_to is null group by 1 having count(*) > 1",
        )
    )
    return " union all ".join(f"({f})" for f in found)


WARN_ONLY = [f"{t}.{c}.{k}" for t, d in DECLARED.items() for c in d.lenient for k in ("accepted_values", "between")]
SUMMARY = f"""select check_name, failures,
  case when check_name = 'fct_requests.types_are_mapped'
       then case when failures > 10000 then 'error' when failures > 0 then 'warn' else 'pass' end
       when check_name = 'fct_requests.no_future_milestones'
       then case when failures > 10 then 'warn' else 'pass' end
       when failures = 0 then 'pass'
       when check_name in ({', '.join(repr(n) for n in WARN_ONLY)}) then 'warn'
       else 'error' end as outcome
  from ({all_findings()})"""

ORDER_PARENTS = {
    "dim_category": "od_cat",
    "dim_agency": "od_agency",
    "dim_location": "loc",
    "dim_weather_band": "bands",
    "dim_date": "od_cal",
}
RELATIONSHIPS = " union all ".join(
    count_rows(c, orphans("od_fact", c, ORDER_PARENTS[parent], field))
    for c, (parent, field) in DECLARED["fct_requests"].references.items()
)


def aged(name: str, newest: str, warn_hours: int, error_hours: int) -> str:
    age = f"timestamp '2024-02-01' - ({newest})"
    return f"""select '{name}' as source_name, ({newest})::timestamp as max_loaded_at,
    case when {age} > to_hours({error_hours}) then 'error' when {age} > to_hours({warn_hours}) then 'warn'
    else 'pass' end as outcome"""


SELECTS: dict[str, str] = {
    "stg_requests": "select * from ev_stg",
    "stg_weather": "select * from ev_wx_stg",
    "int_requests": "select * from ev_int",
    "int_weather_banded": "select * from od_wx",
    "temp_band_ladder": readings("temp_band", "temp", "round(value % 100, 1)"),
    "precip_band_ladder": readings("precip_band", "precip", "round((event_id % 70) / 100, 2)"),
    "snow_band_ladder": readings("snow_band", "snow", "round((event_id % 40) / 10, 1)"),
    "surrogate_keys": f"""select request_id, {md5_key('agency_code', 'borough_name')} as place_key,
      {md5_key('created_at::date', 'complaint_type')} as day_type_key from ev_stg""",
    "dim_date": demand("ev_cal", "date_key", "created_date_local"),
    "dim_agency": "select * from ev_agency",
    "dim_location": demand("loc", "location_key"),
    "dim_category": demand("ev_cat", "complaint_category_key"),
    "dim_weather_band": demand("bands", "weather_band_key"),
    "fct_requests": "select * from ev_fact",
    "fct_daily": "select * from ev_daily",
    "fct_orders": "select * from od_fact",
    "orders_daily": "select * from oa_daily",
    "agency_performance": "select * from ev_perf",
    "daily_service_levels": """select * exclude (daily_service_level_key, location_key, weather_band_key)
      from ev_daily order by service_date""",
    "heat_season": "select * from oa_heat order by service_date",
    "freshness": FRESHNESS,
    "freshness_banner": BANNER,
    "citywide_daily": """select service_date, sum(requests_created)::bigint as requests_created,
      sum(requests_closed)::bigint as requests_closed from ev_daily group by 1 order by 1""",
    "citywide_order": """select service_date, row_number() over (order by service_date) as place
      from (select distinct service_date from ev_daily)""",
    "agency_rollup": ROLLUP,
    "top_agencies": f"{ROLLUP} limit 15",
    "by_borough_category": """select borough_name, service_category,
      sum(requests_created)::bigint as requests_created
      from ev_daily where borough_name <> 'UNKNOWN' group by all""",
    "service_level_trend": f"""select date_trunc('month', service_date)::date as month, service_category, {SHARE}
      from ev_daily group by all having sum(closures_measured) > 200""",
    "agencies": "select distinct agency_code, agency_name from ev_perf order by agency_code",
    "agency_selected": SELECTED,
    "top_selected": f"{SELECTED} limit 20",
    "agency_totals": f"select {PERF_TOTALS}, {MEAN_HOURS} from ev_perf where agency_code = 'A1'",
    "agency_by_borough": f"""select borough_name, {MEAN_HOURS} from ev_perf
      where agency_code = 'A1' and borough_name <> 'UNKNOWN' group by 1 order by 2 desc""",
    "heat_daily": "select service_date, is_heat_season, temp_mean_f, heat_requests from ev_heat order by 1",
    "in_season": by_temperature("is_heat_season"),
    "out_of_season": by_temperature("not is_heat_season"),
    "by_weather": f"""select temp_band, precip_band, sum(requests_created)::bigint as requests_created, {SHARE}
      from ev_daily where temp_band <> 'Unknown' group by all having sum(closures_measured) > 500""",
    "snow_days": f"""select snow_band, sum(requests_created)::bigint as requests_created, {MEAN_HOURS}
      from ev_daily where snow_band <> 'Unknown' group by 1""",
    "cursor_read": """select *, max(resolution_action_updated_date) over () as next_cursor
      from x2_raw where resolution_action_updated_date >= timestamp '2024-01-20'""",
    "dual_cursor": CHANGED,
    "raw_upsert": UPSERTED,
    "raw_upsert_table": UPSERTED,
    "raw_upsert_landed": f"select {RAW_COLUMNS} from corrected_raw",
    "capped_landing": f"select {RAW_COLUMNS} from ev_raw",
    "load_ledger": """select 'run-' || i as load_id, 0::bigint as status, i < 3 as landed_rows
      from (select unnest(range(4)) as i) where (select count(*) from events) > 0""",
    "agency_sightings": """select agency_code, agency_name, max(created_at) as last_seen from ev_stg
      where agency_code is not null group by all""",
    "seed_demand": """select complaint_type, service_category, service_subcategory, is_weather_sensitive,
      (select count(*) from ev_stg r where r.complaint_type = s.complaint_type) as requests_created
      from ev_seed s""",
    "lookback_watermark": """select max(m) - interval 5 day as start from (
      select coalesce(resolution_updated_at, created_at) as m from ev_fact) where m <= timestamp '2024-01-30'""",
    "stored_extract": "select * from ev_perf",
    "sketch_percentiles": SKETCHES,
    "trailing_reload": """select * exclude (late) replace (
        temperature_2m_max + late as temperature_2m_max, temperature_2m_min + late as temperature_2m_min,
        temperature_2m_mean + late as temperature_2m_mean)
      from (select *, case when observed_on between date '2024-01-17' and date '2024-01-31'
            then 0 else 1 end as late from ev_wx_raw)""",
    "payload_unpivot": """select * exclude (_dlt_load_id), timestamp '2024-02-01' as _extracted_at
      from ev_wx_raw""",
    "extract_audit": AUDIT,
    "extract_audit_edges": """with pages as (select user_id as walk, event_id // 16 as page from events),
      whole as (select min(page) as lo, max(page) as hi from pages),
      per as (select walk, min(page) as lo, max(page) as hi from pages group by 1)
      select walk, 'missing_first' as finding, whole.lo as expected_no, per.lo as landed_no
        from per, whole where per.lo <> whole.lo
      union all select walk, 'missing_last', whole.hi, per.hi from per, whole where per.hi <> whole.hi""",
    "extract_manifest": """select o_orderkey from orders
      where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "landing_json": f"select {RAW_COLUMNS} from ev_raw",
    "resumable_ingest": f"select {RAW_COLUMNS} from ev_raw",
    "additive_columns": """from x2_stg union all by name
      select * exclude (channel_type, latitude, longitude) from x1_stg
      where request_id not in (select request_id from x2_stg)""",
    "clustered_sink": """select strftime(created_date_local, '%Y-%m') as month_part, count(*) as requests,
      count(*) filter (is_closed) as closed, 0::bigint as out_of_order from ev_fact group by 1""",
    "incremental_merge": "select * from merged",
    "incremental_merge_table": "select * from merged",
    "scd2_history": HIST,
    "scd2_replayed": HIST,
    "scd2_current": f"{HIST} where dbt_valid_to is null",
    "scd2_point_in_time": """select s.request_id, asked_at, h.status, h.dbt_valid_from, h.dbt_valid_to
      from (select request_id, created_at::date + interval 36 hour as asked_at from ev_stg) s
      left join hist h on h.request_id = s.request_id and asked_at >= h.dbt_valid_from
        and (h.dbt_valid_to is null or asked_at < h.dbt_valid_to)""",
    "time_in_status": """select status, agency_code, count(*) as versions,
      sum(date_sub('hour', dbt_valid_from, dbt_valid_to))::bigint as hours_in_status
      from hist where dbt_valid_to is not null group by all""",
    "stale_open_versions": """select request_id, status, dbt_valid_from from hist
      where dbt_valid_to is null and status = 'Open' and request_id not in (select request_id from x2_src)""",
    "dq_summary": SUMMARY,
    "dq_row_checks": count_terms("fct_requests"),
    "dq_relationships": RELATIONSHIPS,
    "dq_duplicates": "select event_id::varchar as unique_key, 2::bigint as n from events where event_id % 10 = 0",
    "dq_reconcile": """select (select count(*) from ev_fact) as request_count,
      (select sum(requests_created)::bigint from ev_daily) as daily_count""",
    "dq_unreconciled": """select * from (select (select count(*) from od_fact) as request_count,
      (select sum(requests_created)::bigint from od_daily) as daily_count) where request_count <> daily_count""",
    "dq_dropped_closures": """select closures, daily_closures, closures - daily_closures as dropped from (
      select (select count(*) from ev_fact where is_closed) as closures,
        (select sum(requests_closed)::bigint from ev_daily) as daily_closures)""",
    "dq_unmapped_types": """select complaint_type, count(*) as unmapped_requests from ev_fact
      where is_unmapped_complaint_type group by 1""",
    "dq_future_milestones": f"""select request_id, created_at, closed_at, resolution_updated_at
      from ev_fact where {FUTURE}""",
    "dq_current_versions": """select open_versions, count(*) as requests from (
      select request_id, count(*) as open_versions from hist where dbt_valid_to is null group by 1) group by 1""",
    "source_freshness": " union all ".join(
        [
            aged("service_requests", "select max(created_date) from ev_raw", 72, 168),
            aged("weather_daily", "select max(observed_on)::timestamp from ev_wx_raw", 192, 336),
            aged("loads", "select max(inserted_at) from ev_loads", 36, 72),
        ]
    ),
    "stream_upsert": "select * from ev_raw",
    "stream_dedup": "select * from events",
    "stream_daily_demand": """with t as (
        select ((ts at time zone 'UTC') at time zone 'America/New_York') as local_ts, event_type from events)
      select local_ts::date as service_date, event_type, count(*) as requests_created from t group by all""",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
