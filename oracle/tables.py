"""Shared table expressions of the oracle, and the assembly of complete statements."""

from __future__ import annotations

import re

NULL_KEY = "_dbt_utils_surrogate_key_null_"
# The same white space characters that the library strips.
BLANKS = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(5760)"
    + "".join(f" || chr({n})" for n in [*range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
)


def md5_key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(({p})::varchar, '{NULL_KEY}')" for p in parts) + ")"


def clean(column: str) -> str:
    return f"nullif(trim({column}, {BLANKS}), '')"


def new_york_day(column: str) -> str:
    return f"((({column}) at time zone 'UTC') at time zone 'America/New_York')::date"


def staged(source: str) -> str:
    return f"""
    select unique_key as request_id, created_date as created_at, closed_date as closed_at,
      resolution_action_updated_date as resolution_updated_at,
      {clean('agency')} as agency_code, {clean('agency_name')} as agency_name,
      {clean('complaint_type')} as complaint_type, {clean('descriptor')} as descriptor,
      {clean('location_type')} as location_type, {clean('incident_zip')} as incident_zip,
      nullif({clean('borough')}, 'Unspecified') as borough_name, {clean('status')} as status,
      {clean('open_data_channel_type')} as channel_type,
      try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
      _dlt_load_id as dlt_load_id
    from {source}"""


def measured(source: str, seed: str) -> str:
    return f"""
    select s.*, coalesce(c.service_category, 'Unmapped') as service_category,
      coalesce(c.service_subcategory, 'Unmapped') as service_subcategory,
      coalesce(c.is_weather_sensitive, false) as is_weather_sensitive,
      {md5_key("coalesce(c.complaint_type, 'Unmapped')")} as complaint_category_key,
      c.complaint_type is null as is_unmapped_complaint_type,
      {new_york_day('s.created_at')} as created_date_local,
      {new_york_day('s.closed_at')} as closed_date_local,
      s.closed_at is not null as is_closed,
      date_sub('hour', s.created_at, s.closed_at) as resolution_hours,
      date_sub('hour', s.created_at, s.closed_at) / 24.0::double as resolution_days,
      coalesce(s.closed_at < s.created_at or date_sub('hour', s.created_at, s.closed_at) > 8760, false)
        as is_implausible_resolution
    from {source} s left join {seed} c using (complaint_type)"""


def weather_raw(table: str, moment: str, one: str, other: str) -> str:
    return f"""
    select d as observed_on, mean + 5 as temperature_2m_max, mean - 5 as temperature_2m_min,
      mean as temperature_2m_mean, rain as precipitation_sum, rain as rain_sum, snow as snowfall_sum,
      (n % 60)::double as wind_speed_10m_max, 'load-weather' as _dlt_load_id
    from (
      select {moment}::date as d, count(*) as n,
        ((sum({one}) + count(*)) % 45 - 10)::double as mean,
        greatest(sum({other}) % 240 - 60, 0)::double / 10 as rain,
        greatest(sum({one}) % 110 - 50, 0)::double / 10 as snow
      from {table}
      group by 1 having day({moment}::date) % 7 <> 0)"""


def weather_staged(source: str) -> str:
    def f(c):
        return f"round(temperature_2m_{c} * 9 / 5 + 32, 1) as temp_{c}_f"

    return f"""
    select observed_on as weather_date, temperature_2m_max as temp_max_c,
      temperature_2m_min as temp_min_c, temperature_2m_mean as temp_mean_c,
      {f('max')}, {f('min')}, {f('mean')},
      precipitation_sum as precipitation_mm, rain_sum as rain_mm, snowfall_sum as snowfall_cm,
      wind_speed_10m_max as wind_speed_max_kmh,
      round(precipitation_sum / 25.4::double, 2) as precipitation_in,
      round(snowfall_sum / 2.54::double, 2) as snowfall_in, _dlt_load_id as dlt_load_id
    from {source}"""


# Ladders as lookup rows: [low, high) -> band. An exact zero has a row of its own.
LADDERS = {
    "temp": [(None, 32, "Freezing"), (32, 50, "Cold"), (50, 70, "Mild"), (70, 85, "Warm"), (85, None, "Hot")],
    "precip": [(0, 0, "None"), (None, 0.1, "Light"), (0.1, 0.5, "Moderate"), (0.5, None, "Heavy")],
    "snow": [(0, 0, "None"), (None, 2, "Light"), (2, None, "Significant")],
}


def ladder(kind: str, column: str) -> str:
    arms = []
    for low, high, band in LADDERS[kind]:
        if low == high:
            arms.append(f"when {column} = {low} then '{band}'")
        else:
            bounds = [f"{column} >= {low}"] if low is not None else []
            bounds += [f"{column} < {high}"] if high is not None else []
            arms.append(f"when {' and '.join(bounds)} then '{band}'")
    return f"case {' '.join(arms)} else 'Unknown' end"


def weather_banded(source: str) -> str:
    return f"""
    select *, {md5_key('temp_band', 'precip_band', 'snow_band')} as weather_band_key from (
      select weather_date, temp_max_f, temp_min_f, temp_mean_f, precipitation_in, snowfall_in,
        wind_speed_max_kmh, {ladder('temp', 'temp_mean_f')} as temp_band,
        {ladder('precip', 'precipitation_in')} as precip_band,
        {ladder('snow', 'snowfall_in')} as snow_band
      from {source})"""


def calendar(start: str, end: str) -> str:
    """Days from start up to, not including, end; both are date expressions."""
    return f"""
    select d as date_key, year(d)::int as calendar_year, quarter(d)::int as calendar_quarter,
      month(d)::int as calendar_month, monthname(d) as month_name, strftime(d, '%Y-%m') as year_month,
      dayofweek(d)::int + 1 as day_of_week, dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend,
      date_trunc('week', d)::date as week_start_date, date_trunc('month', d)::date as month_start_date,
      month(d) not in (6, 7, 8, 9) as is_heat_season,
      case when month(d) in (12, 1, 2) then 'Winter' when month(d) < 6 then 'Spring'
           when month(d) < 9 then 'Summer' else 'Autumn' end as season
    from (select unnest(range({start}, {end}, interval 1 day))::date as d)"""


def agencies(source: str) -> str:
    return f"""
    select {md5_key('agency_code')} as agency_key, * from (
      select agency_code, coalesce(arg_max(agency_name, (created_at, name_rank))
          filter (agency_name is not null), agency_code) as agency_name, true as is_known_agency
      from (select *, -dense_rank() over (order by agency_name) as name_rank
            from {source} where agency_code is not null)
      group by agency_code
      union all select 'UNKNOWN', 'Unknown', false)"""


def fact(source: str, weather: str, start: str) -> str:
    unknown = md5_key("'Unknown'", "'Unknown'", "'Unknown'")
    return f"""
    select request_id, complaint_category_key,
      {md5_key("coalesce(agency_code, 'UNKNOWN')")} as agency_key,
      {md5_key("coalesce(borough_name, 'UNKNOWN')")} as location_key,
      coalesce(w.weather_band_key, {unknown}) as weather_band_key,
      created_date_local, closed_date_local, created_at, resolution_updated_at, closed_at,
      complaint_type, descriptor, service_category, service_subcategory,
      coalesce(agency_code, 'UNKNOWN') as agency_code, coalesce(borough_name, 'UNKNOWN') as borough_name,
      incident_zip, status, channel_type, latitude, longitude, resolution_hours, resolution_days,
      is_closed, is_weather_sensitive, is_unmapped_complaint_type, is_implausible_resolution,
      case when is_closed and not is_implausible_resolution then resolution_hours end
        as reportable_resolution_hours, dlt_load_id
    from {source} left join {weather} w on w.weather_date = created_date_local
    where created_at >= {start}"""


def daily(fact_table: str, calendar_table: str, categories: str, weather: str) -> str:
    unknown = md5_key("'Unknown'", "'Unknown'", "'Unknown'")
    group = "service_date, borough_name, service_category"
    return f"""
    select {group}, {md5_key('service_date', 'borough_name', 'service_category')} as daily_service_level_key,
      {md5_key('borough_name')} as location_key, coalesce(w.weather_band_key, {unknown}) as weather_band_key,
      coalesce(requests_created, 0) as requests_created, coalesce(requests_closed, 0) as requests_closed,
      avg_resolution_hours, median_resolution_hours, p90_resolution_hours,
      coalesce(closed_within_1_day, 0) as closed_within_1_day,
      coalesce(closed_within_3_days, 0) as closed_within_3_days,
      coalesce(closures_measured, 0) as closures_measured,
      closed_within_3_days / nullif(closures_measured, 0) as pct_closed_within_3_days,
      temp_mean_f, precipitation_in, snowfall_in, temp_band, precip_band, snow_band
    from (
      select date_key as service_date, borough_name, service_category
      from {calendar_table}, loc, (select distinct service_category from {categories})
      where date_key >= (select min(created_date_local) from {fact_table})
        and date_key <= (select max(created_date_local) from {fact_table}))
    left join (
      select created_date_local as service_date, borough_name, service_category,
        count(*) as requests_created
      from {fact_table} group by all) using ({group})
    left join (
      select closed_date_local as service_date, borough_name, service_category,
        count(*) as requests_closed, avg(reportable_resolution_hours) as avg_resolution_hours,
        quantile_disc(reportable_resolution_hours, 0.5) as median_resolution_hours,
        quantile_disc(reportable_resolution_hours, 0.9) as p90_resolution_hours,
        count(*) filter (reportable_resolution_hours <= 24) as closed_within_1_day,
        count(*) filter (reportable_resolution_hours <= 72) as closed_within_3_days,
        count(reportable_resolution_hours) as closures_measured
      from {fact_table} where closed_date_local is not null group by all) using ({group})
    left join {weather} w on w.weather_date = service_date"""


def performance(fact_table: str, agency_table: str) -> str:
    """Counts per agency key first; percentiles apart, from the measured closures in order."""
    group = "agency_key, borough_name, service_category"
    return f"""
    with measured as (
      select {group}, reportable_resolution_hours as hours,
        row_number() over (partition by {group} order by reportable_resolution_hours) as place,
        count(*) over (partition by {group}) as n
      from {fact_table} where reportable_resolution_hours is not null),
    ranks as (
      select {group}, min(hours) filter (place * 100 >= n * 50) as median_resolution_hours,
        min(hours) filter (place * 100 >= n * 90) as p90_resolution_hours,
        avg(hours) as avg_resolution_hours, count(*) as closures_measured,
        sum((hours <= 72)::int)::bigint as closed_within_3_days
      from measured group by all),
    totals as (
      select {group}, count(*) as requests_total, sum(is_closed::int)::bigint as requests_closed
      from {fact_table} group by all)
    select agency_code, agency_name, borough_name, service_category, requests_total, requests_closed,
      requests_total - requests_closed as requests_open, avg_resolution_hours, median_resolution_hours,
      p90_resolution_hours, coalesce(closures_measured, 0) as closures_measured,
      coalesce(closed_within_3_days, 0) as closed_within_3_days,
      closed_within_3_days / closures_measured as pct_closed_within_3_days
    from totals left join ranks using ({group}) join {agency_table} using (agency_key)"""


def heat(calendar_table: str, fact_table: str, daily_table: str) -> str:
    """The fact by day and kind first, then put beside the calendar."""
    return f"""
    with kinds as (
      select created_date_local as service_date, service_subcategory = 'Heat & Hot Water' as heat, count(*) as n,
        avg(reportable_resolution_hours) as hours
      from {fact_table} group by all),
    days as (
      select service_date, coalesce(max(case when heat then n end), 0) as heat_requests,
        coalesce(max(case when not heat then n end), 0) as other_requests,
        max(case when heat then hours end) as heat_avg_resolution_hours
      from kinds group by all),
    weather as (select distinct service_date, temp_mean_f from {daily_table})
    select service_date, is_heat_season, temp_mean_f, heat_requests, other_requests, heat_avg_resolution_hours
    from days left join weather using (service_date)
    join (select date_key as service_date, is_heat_season from {calendar_table}) using (service_date)"""


def extract_at(source: str, moment: str) -> str:
    """The feed as it stood at a moment."""
    known = f"closed_date <= timestamp '{moment}'"
    return f"""
    select * replace (
      case when {known} then closed_date end as closed_date,
      case when {known} then closed_date end as resolution_action_updated_date,
      case when {known} then 'Closed' else 'Open' end as status)
    from {source} where created_date <= timestamp '{moment}'"""


def tracked(source: str, horizon: str) -> str:
    return f"""
    select request_id, status, agency_code, complaint_type, borough_name, created_at, closed_at,
      resolution_updated_at, coalesce(resolution_updated_at, created_at) as status_changed_at
    from {source} where closed_at is null or closed_at >= timestamp '{horizon}'"""


STAMP = "strftime(status_changed_at, '%Y-%m-%d %H:%M:%S.%f')"

TABLES: dict[str, str] = {
    "ev_raw": """
    select event_id::varchar as unique_key, ts as created_date,
      case when event_id % 11 = 0 then null
           when event_id % 97 = 0 then ts - to_minutes(90)
           when event_id % 101 = 0 then ts + to_minutes(600000)
           else ts + to_minutes(floor(value * 100)::bigint) end as closed_date,
      closed_date as resolution_action_updated_date,
      case user_id % 6 when 4 then null when 5 then '  ' else ' A' || (user_id % 6) end as agency,
      case when event_id % 5 <> 0 then
        case when ts < timestamp '2024-01-16' then 'Desk ' else 'Bureau ' end || (user_id % 6) end as agency_name,
      event_type || ' ' as complaint_type, props as descriptor, ' ' || chr(9) as location_type,
      (10000 + user_id % 500)::varchar as incident_zip,
      ['BRONX', 'BROOKLYN', 'MANHATTAN', 'QUEENS', 'STATEN ISLAND', 'Unspecified', '', null]
        [(user_id % 8 + 1)::int] as borough,
      case when closed_date is null then 'Open' else 'Closed' end as status,
      case when event_id % 3 = 0 then 'PHONE' else 'ONLINE' end as open_data_channel_type,
      case when event_id % 13 = 0 then 'n/a' else '40.' || (400 + user_id % 600) end as latitude,
      '-73.' || (600 + user_id % 400) as longitude, 'load-' || strftime(ts, '%Y%m%d') as _dlt_load_id
    from events""",
    "ev_seed": """
    select * from (values ('view', 'Housing & Buildings', 'Heat & Hot Water', true),
      ('click', 'Housing & Buildings', 'Elevators', false),
      ('signup', 'Streets & Sidewalks', 'Potholes', true),
      ('purchase', 'Noise', 'Residential Noise', false))
      t(complaint_type, service_category, service_subcategory, is_weather_sensitive)""",
    "ev_stg": staged("ev_raw"),
    "ev_int": measured("ev_stg", "ev_seed"),
    "ev_wx_raw": weather_raw("events", "ts", "event_id", "user_id"),
    "ev_wx_stg": weather_staged("ev_wx_raw"),
    "ev_wx": weather_banded("ev_wx_stg"),
    "ev_cal": calendar("date '2023-01-01'", "date '2025-01-31'"),
    "loc": f"""
    select {md5_key('borough_name')} as location_key, * from (values
      ('BRONX', 'Bronx', 36005::bigint, 'Bronx', true), ('BROOKLYN', 'Brooklyn', 36047, 'Kings', true),
      ('MANHATTAN', 'Manhattan', 36061, 'New York', true), ('QUEENS', 'Queens', 36081, 'Queens', true),
      ('STATEN ISLAND', 'Staten Island', 36085, 'Richmond', true), ('UNKNOWN', 'Unknown', null, null, false))
      t(borough_name, borough_label, county_fips, county_name, is_known_borough)""",
    "ev_cat": f"""
    select {md5_key('complaint_type')} as complaint_category_key, * from (
      from ev_seed union all select 'Unmapped', 'Unmapped', 'Unmapped', false)""",
    "bands": f"""
    select {md5_key('temp_band', 'precip_band', 'snow_band')} as weather_band_key,
      temp_band, precip_band, snow_band, temp_band || ', ' || precip_band || ' precip' as weather_band_label,
      temp_band in ('Freezing', 'Hot') as is_temperature_extreme,
      precip_band = 'Heavy' or snow_band = 'Significant' as is_severe_precipitation
    from unnest(['Freezing', 'Cold', 'Mild', 'Warm', 'Hot', 'Unknown']) t(temp_band),
      unnest(['None', 'Light', 'Moderate', 'Heavy', 'Unknown']) p(precip_band),
      unnest(['None', 'Light', 'Significant', 'Unknown']) s(snow_band)""",
    "ev_agency": agencies("ev_stg"),
    "ev_fact": fact("ev_int", "ev_wx", "timestamp '2023-01-01'"),
    "ev_daily": daily("ev_fact", "ev_cal", "ev_cat", "ev_wx"),
    "ev_perf": performance("ev_fact", "ev_agency"),
    "ev_heat": heat("ev_cal", "ev_fact", "ev_daily"),
    "ev_loads": """
    select 'load-' || strftime(ts::date, '%Y%m%d') as load_id,
      case when day(ts::date) % 5 = 0 then 1 else 0 end::bigint as status, max(ts) as inserted_at
    from events group by ts::date""",
    # Orders
    "od_raw": """
    select o_orderkey::varchar as unique_key, o_orderdate as created_date, closed_date,
      closed_date as resolution_action_updated_date, 'B' || (o_custkey % 7) as agency,
      'Branch ' || (o_custkey % 7) as agency_name, o_orderpriority as complaint_type,
      null::varchar as descriptor, null::varchar as location_type, null::varchar as incident_zip,
      ['BRONX', 'BROOKLYN', 'MANHATTAN', 'QUEENS', 'STATEN ISLAND'][r_regionkey + 1] as borough,
      case o_orderstatus when 'F' then 'Closed' when 'P' then 'Pending' else 'Open' end as status,
      'ONLINE' as open_data_channel_type, null::varchar as latitude, null::varchar as longitude,
      'load-orders' as _dlt_load_id
    from orders
    left join (select l_orderkey, max(l_shipdate) as closed_date from lineitem group by 1)
      on l_orderkey = o_orderkey
    left join (select c_custkey, r_regionkey from customer join nation on c_nationkey = n_nationkey
               join region on n_regionkey = r_regionkey) on c_custkey = o_custkey""",
    "od_seed": """
    select * from (values ('1-URGENT', 'Emergency', 'Heat & Hot Water', true),
      ('2-HIGH', 'Emergency', 'Flooding', true), ('3-MEDIUM', 'Routine', 'Repairs', false),
      ('5-LOW', 'Routine', 'Inspections', false))
      t(complaint_type, service_category, service_subcategory, is_weather_sensitive)""",
    "od_stg": staged("od_raw"),
    "od_int": measured("od_stg", "od_seed"),
    "od_wx_raw": weather_raw("orders", "o_orderdate", "o_orderkey", "o_custkey"),
    "od_wx_stg": weather_staged("od_wx_raw"),
    "od_wx": weather_banded("od_wx_stg"),
    "od_cal": calendar("date '1995-01-01'", "date '2000-12-31'"),
    "od_cat": f"""
    select {md5_key('complaint_type')} as complaint_category_key, * from (
      from od_seed union all select 'Unmapped', 'Unmapped', 'Unmapped', false)""",
    "od_agency": agencies("od_stg"),
    "od_fact": fact("od_int", "od_wx", "timestamp '1998-01-01'"),
    "od_daily": daily("od_fact", "od_cal", "od_cat", "od_wx"),
    # All orders: clock, window and calendar from the first and the last of them
    "oa_cal": calendar(
        "(select min(o_orderdate)::date - 1 from orders)",
        "(select (max(o_orderdate)::date + interval 1 year)::date from orders)",
    ),
    "oa_fact": fact("od_int", "od_wx", "(select min(o_orderdate) from orders)"),
    "oa_daily": daily("oa_fact", "oa_cal", "od_cat", "od_wx"),
    "oa_heat": heat("oa_cal", "oa_fact", "oa_daily"),
    # Two extracts of the events feed
    "x1_raw": extract_at("ev_raw", "2024-01-15"),
    "x2_raw": extract_at("ev_raw", "2024-01-30"),
    "x1_stg": staged("x1_raw"),
    "x2_stg": staged("x2_raw"),
    "x1_int": measured("x1_stg", "ev_seed"),
    "x2_int": measured("x2_stg", "ev_seed"),
    "x1_fact": fact("x1_int", "ev_wx", "timestamp '2023-01-01'"),
    "x2_fact": fact("x2_int", "ev_wx", "timestamp '2023-01-01'"),
    # The second run re-reads what moved within five days of the first run's newest movement.
    "x2_batch": """
    from x2_fact where coalesce(resolution_updated_at, created_at) >=
      (select max(coalesce(resolution_updated_at, created_at)) from x1_fact
       where coalesce(resolution_updated_at, created_at) <= timestamp '2024-01-30') - interval 5 day""",
    # A later landing that takes closures back, or corrects them to an earlier time
    "corrected_raw": """
    select * replace (
      case unique_key::bigint % 7 when 0 then null when 1 then closed_date - interval 90 minute
        else closed_date end as closed_date,
      case unique_key::bigint % 7 when 0 then null when 1 then closed_date - interval 90 minute
        else resolution_action_updated_date end as resolution_action_updated_date,
      case when unique_key::bigint % 7 = 0 then 'Open' else status end as status)
    from x1_raw""",
    "merged": """
    from x2_batch union all by name from x1_fact where request_id not in (select request_id from x2_batch)""",
    "x1_src": tracked("x1_stg", "2024-01-08"),
    "x2_src": tracked("x2_stg", "2024-01-23"),
    "versions": """
    from x1_src union all by name
    select s.* from x2_src s left join x1_src f using (request_id)
    where f.request_id is null or s.status_changed_at > f.status_changed_at""",
    "hist": f"""
    select *, md5(request_id || '|' || {STAMP}) as dbt_scd_id, status_changed_at as dbt_updated_at,
      status_changed_at as dbt_valid_from,
      (select min(n.status_changed_at) from versions n
       where n.request_id = v.request_id and n.status_changed_at > v.status_changed_at) as dbt_valid_to
    from versions v""",
}


def statement(select: str) -> str:
    """A complete statement: the select, preceded by the table expressions it needs."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in (words & TABLES.keys()) - needed:
            needed.add(name)
            pending.append(TABLES[name])
    if needed and select.lstrip().startswith("with"):
        select = f"select * from ({select})"
    parts = [f"{name} as ({TABLES[name]})" for name in TABLES if name in needed]
    return (f"with {', '.join(parts)}\n" if parts else "") + select
