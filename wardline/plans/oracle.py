"""SQL counterpart of every registered query, for an independent engine over the same tables."""

from __future__ import annotations

from wardline.operators.narrative import SYSTEM_TEXT
from wardline.plans.sample import SAMPLE_CATEGORIES
from wardline.schema import CATEGORIES, FORCES, HOTSPOT_COUNTS

# Named subqueries; each may use the ones before it.
_PARTS: dict[str, str] = {}

_category_cases = " ".join(
    f"when {i} then '{name}'" for i, name in enumerate(SAMPLE_CATEGORIES)
)

_PARTS["raw"] = f"""
select
  case when l_linenumber = 7 then '' when l_linenumber = 6 then '  '
       when l_linenumber = 5 then null
       else l_orderkey::varchar || '-' || l_linenumber::varchar end as crime_id,
  case when l_partkey % 97 = 0 then null else substr(l_shipdate::varchar, 1, 7) end as month,
  r_name || ' Police' as falls_within,
  case when l_suppkey % 50 = 0 then null else -2 + (l_partkey % 1000) * 0.001::double end as longitude,
  case when l_suppkey % 49 = 0 then null else 53 + (l_suppkey % 1000) * 0.001::double end as latitude,
  ' On or near Street ' || l_suppkey::varchar as location,
  'E' || lpad((n_nationkey * 3 + l_partkey % 3)::varchar, 8, '0') as lsoa_code,
  ' ' || n_name || ' ' || lpad((l_partkey % 3 + 1)::varchar, 3, '0') || 'A ' as lsoa_name,
  case when l_partkey % 101 = 0 then null
       else case l_partkey % 9 {_category_cases} end end as crime_type,
  case when l_returnflag = 'A' then 'Under investigation'
       when l_returnflag = 'R' then 'Investigation complete; no suspect identified'
       when l_linestatus = 'O' then case when l_quantity > 25 then ' ' end
       else 'Offender given a caution' end as last_outcome,
  ' ' || lower(r_name) as force,
  l_shipdate::date + l_linenumber::integer as loaded_on
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""

_PARTS["staged"] = r"""
select
  nullif(trim(crime_id), '') as crime_id, month,
  split_part(month, '-', 1)::integer as year, split_part(month, '-', 2)::integer as month_num,
  trim(force) as force, trim(lsoa_code) as lsoa_code, trim(lsoa_name) as lsoa_name,
  regexp_replace(trim(lsoa_name), ' \d+.*$', '') as district,
  longitude, latitude, trim(location) as location, trim(crime_type) as crime_type,
  coalesce(nullif(trim(last_outcome), ''), 'No outcome recorded') as last_outcome, loaded_on
from raw where month is not null and crime_type is not null
"""



def _share_where(condition: str) -> str:
    """Percentage of a group's rows that meet a condition."""
    return f"round(100.0 * count(*) filter (where {condition}) / count(*), 2)"


_PARTS["by_category"] = f"""
select year, month_num, month, force, crime_type, count(*) as total_crimes,
  count(crime_id) as crimes_with_id,
  {_share_where("last_outcome = 'Under investigation'")} as pct_under_investigation
from staged group by all
"""

_PARTS["by_month"] = """
select *, round(100.0 * (total_crimes - prev_year_crimes) / nullif(prev_year_crimes, 0), 2)
    as yoy_pct_change
from (
  select *, lag(total_crimes) over (partition by force, month_num order by year) as prev_year_crimes
  from (select year, month_num, month, force, count(*) as total_crimes from staged group by all)
)
"""

_NO_SUSPECT = "'Investigation complete; no suspect identified'"

_PARTS["by_force"] = f"""
select force, year, month, count(*) as total_crimes,
  count(distinct crime_type) as distinct_crime_types,
  {_share_where("last_outcome = 'Under investigation'")} as pct_under_investigation,
  {_share_where(f"last_outcome = {_NO_SUSPECT}")} as pct_no_suspect,
  {_share_where(f"last_outcome not in ('Under investigation', 'No outcome recorded', {_NO_SUSPECT})")}
    as pct_resolved
from staged group by force, year, month
"""

_hotspot_counts = ", ".join(
    f"count(*) filter (where crime_type = '{name}') as {column}"
    for column, name in HOTSPOT_COUNTS.items()
)

# Degrees are summed as decimals: a double sum depends on the order of rows.
_PARTS["hotspots"] = f"""
select lsoa_code, lsoa_name, district, force, year, month,
  round(sum(latitude::decimal(9,6))::double / count(*), 6) as centroid_lat,
  round(sum(longitude::decimal(9,6))::double / count(*), 6) as centroid_lon,
  count(*) as total_crimes, {_hotspot_counts},
  case when count(*) >= 20 then 'High' when count(*) >= 10 then 'Medium' else 'Low' end
    as hotspot_tier
from staged where latitude is not null and longitude is not null and lsoa_code is not null
group by lsoa_code, lsoa_name, district, force, year, month
"""

_PICKED_FORCE = "force in ('africa', 'asia', 'europe')"
_PICKED = f"{_PICKED_FORCE} and year between 1996 and 1999"
_PICKED_TYPE = (
    f"{_PICKED} and crime_type in ('Burglary', 'Drugs', 'Robbery', 'Shoplifting', 'Vehicle crime')"
)

_PARTS["report_rows"] = """
select falls_within, month, trim(crime_type) as crime_type, last_outcome
from raw where crime_type is not null and month is not null
"""

# The same with a gap: of one force no month of May has arrived, and rows without a month are there.
_PARTS["gapped_rows"] = """
select falls_within, month, trim(crime_type) as crime_type, last_outcome
from raw where crime_type is not null and not coalesce(falls_within = 'ASIA Police' and month like '%-05', false)
"""

_SHARES = """
select *, share + case when rank = 1 then 100 - sum(share) over (partition by falls_within, month)
  else 0 end as pct
from (
  select *, round_even(100 * incidents::double / total, 1)::decimal(9,1) as share,
    row_number() over (partition by falls_within, month order by incidents desc, crime_type) as rank
  from (
    select *, sum(incidents) over (partition by falls_within, month)::bigint as total
    from (select falls_within, month, crime_type, count(*) as incidents from {rows}
      where falls_within is not null and month is not null group by all)
  )
)
"""

_FEATURES = """
select *, case when absolute > 0 then 'increase' when absolute < 0 then 'decrease'
    when absolute = 0 then 'no change' end as direction,
  round_even(abs(absolute)::double / previous_total * 100, 1) as pct
from (
  select *, total_crimes - previous_total as absolute
  from (
    select force, period, total_crimes, top_three, distribution, top_json, share_json, share_lines,
      case when lag(period) over (partition by force order by period)
          = strftime((period || '-01')::date - interval 1 month, '%Y-%m')
        then lag(total_crimes) over (partition by force order by period) end as previous_total
    from (
      select falls_within as force, month as period, sum(incidents)::bigint as total_crimes,
        string_agg(crime_type, '|' order by rank) filter (where rank <= 3) as top_three,
        string_agg(crime_type || '=' || pct::varchar, '|' order by rank) as distribution,
        string_agg('"' || crime_type || '"', ',' order by rank) filter (where rank <= 3) as top_json,
        string_agg('"' || crime_type || '":' || pct::varchar, ',' order by rank) as share_json,
        string_agg('  - ' || crime_type || ': ' || pct::varchar || '%', chr(10) order by rank)
          as share_lines
      from {shares} group by falls_within, month
    )
  )
)
"""

for _rows, _shares, _features in (("report_rows", "shares", "features"), ("gapped_rows", "gapped_shares", "gapped_features")):
    _PARTS[_shares] = _SHARES.replace("{rows}", _rows)
    _PARTS[_features] = _FEATURES.replace("{shares}", _shares)

_SIGNED = "case when absolute > 0 then '+' else '' end || format('{:,}', absolute)"
_PCT = "pct::decimal(30,1)::varchar || '%'"

_PARTS["prompts"] = f"""
select *, 'Write the note from these figures alone.' || chr(10) || chr(10)
  || 'Police force: ' || force || chr(10) || 'Month: ' || period || chr(10)
  || 'Recorded in all: ' || format('{{:,}}', total_crimes)
  || case when absolute is null then '' else chr(10) || 'Month-on-month: ' || direction
     || ' of ' || {_PCT} || ' (' || {_SIGNED} || ' on ' || format('{{:,}}', previous_total) || ')' end
  || chr(10) || chr(10) || 'By crime type:' || chr(10) || share_lines
  || chr(10) || chr(10) || 'Most frequent: ' || replace(top_three, '|', ', ')
  || chr(10) || chr(10) || 'Sections: Overview, Crime Breakdown, Implications.'
  as user_text
from features
"""

# The raw table holds months up to 1999-06, the batch starts at 1999-01.
_PARTS["keyed"] = """
select nullif(trim(crime_id), '') as crime_id, month, trim(force) as force, crime_type, lsoa_code,
  loaded_on
from raw where month is not null
"""
_PARTS["numbered"] = """
select distinct force, substr(month, 1, 4)::int * 12 + substr(month, 6, 2)::int as n from keyed
"""
_PARTS["loaded"] = "select * from keyed where month <= '1999-06'"
_PARTS["batch"] = "select * from keyed where month >= '1999-01'"
_PARTS["marks"] = """
select force, month, updated_at from (
  select *, row_number() over (partition by force order by updated_at desc, month desc) as n
  from (select force, month, max(loaded_on) as updated_at from keyed
    where month <= greatest((1994 + length(force) % 7)::varchar || '-12', '1996-06') group by force, month)
) where n = 1
"""

_NEEDS = {
    "raw": (),
    "staged": ("raw",),
    "by_category": ("raw", "staged"),
    "by_month": ("raw", "staged"),
    "by_force": ("raw", "staged"),
    "hotspots": ("raw", "staged"),
    "report_rows": ("raw",),
    "shares": ("raw", "report_rows"),
    "features": ("raw", "report_rows", "shares"),
    "prompts": ("raw", "report_rows", "shares", "features"),
    "gapped_rows": ("raw",),
    "gapped_shares": ("raw", "gapped_rows"),
    "gapped_features": ("raw", "gapped_rows", "gapped_shares"),
    "keyed": ("raw",),
    "numbered": ("raw", "keyed"),
    "loaded": ("raw", "keyed"),
    "batch": ("raw", "keyed"),
    "marks": ("raw", "keyed"),
}


def _sql(select: str, *parts: str) -> str:
    wanted = {name for part in parts for name in (*_NEEDS[part], part)}
    named = ", ".join(f"{name} as ({_PARTS[name].strip()})" for name in _PARTS if name in wanted)
    return f"with {named} {select.strip()}"


def _failures(model: str, column: str, rule: str, condition: str) -> str:
    return (
        f"select '{model}' as model, '{column}' as \"column\", '{rule}' as rule, "
        f"count(*) filter (where {condition}) as failures from {model}"
    )


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


_NOT_NULL = [
    *[("staged", c) for c in ("month", "year", "month_num", "force", "crime_type", "last_outcome")],
    *[("by_category", c) for c in ("month", "force", "crime_type", "total_crimes")],
    *[("by_month", c) for c in ("month", "force", "total_crimes")],
    *[("by_force", c) for c in ("force", "month")],
    *[("hotspots", c) for c in ("lsoa_code", "total_crimes")],
]

# Months the test tables hold, each a column of the heat map.
_MONTHS = [f"{1995 + i // 12}-{i % 12 + 1:02d}" for i in range(83)]


def oracle_sql() -> dict[str, str]:
    category = _sql("select * from by_category", "by_category")
    not_null = " union all ".join(
        _failures(model, column, "not_null", f"{column} is null") for model, column in _NOT_NULL
    ).replace("'staged'", "'staging'")
    accepted = " union all ".join(
        [
            _failures("staged", "force", "accepted_values", f"force not in ({_quoted(FORCES)})"),
            _failures(
                "staged", "crime_type", "accepted_values", f"crime_type not in ({_quoted(CATEGORIES)})"
            ),
            _failures(
                "hotspots",
                "hotspot_tier",
                "accepted_values",
                "hotspot_tier not in ('High', 'Medium', 'Low')",
            ),
        ]
    ).replace("'staged'", "'staging'")
    heat = ", ".join(
        f"coalesce(sum(case when month = '{m}' then total_crimes end), 0)::bigint as \"{m}\""
        for m in _MONTHS
    )
    return {
        "stage_incidents": _sql(
            "select * exclude (loaded_on), loaded_on::timestamp::varchar as _loaded_at from staged",
            "staged",
        ),
        "stage_district": _sql(
            "select lsoa_name, district, count(*) as row_count from staged group by all", "staged"
        ),
        "raw_try_cast": """
            select l_orderkey, l_linenumber, l_partkey, try_cast(
              case when l_partkey % 5 = 0 then 'n/a' when l_partkey % 7 = 0 then ''
                when l_partkey % 11 = 0 then ' -' || l_suppkey::varchar || '.5 '
                else l_suppkey::varchar || '.25' end as double) as value
            from lineitem""",
        "mart_by_category": category,
        "cube_rollup_category": category,
        "mart_by_month_yoy": _sql("select * from by_month", "by_month"),
        "mart_by_force": _sql("select * from by_force", "by_force"),
        "mart_hotspots": _sql("select * from hotspots", "hotspots"),
        "outcome_distribution": _sql(
            "select last_outcome, count(*) as cnt from staged group by all", "staged"
        ),
        "kpi_row": _sql(
            f"""select
              (select coalesce(sum(total_crimes), 0)::bigint from by_category where {_PICKED_TYPE})
                as total_crimes,
              (select round_even(avg(pct_under_investigation), 1) from by_force where {_PICKED_FORCE})
                as pct_under_investigation,
              coalesce((select crime_type from by_category where {_PICKED_TYPE} group by crime_type
                order by sum(total_crimes) desc, crime_type limit 1), 'N/A') as top_crime_type,
              (select count(*) from hotspots where {_PICKED} and hotspot_tier = 'High')
                as high_hotspot_rows""",
            "by_category",
            "by_force",
            "hotspots",
        ),
        "filter_domains": _sql(
            """select distinct 'force' as filter, force as value from by_month
            union all select distinct 'year', year::varchar from by_month
            union all select distinct 'crime_type', crime_type from by_category""",
            "by_month",
            "by_category",
        ),
        "trend_by_month_force": _sql(
            f"""select month, force, sum(total_crimes)::bigint as total_crimes from by_month
            where {_PICKED} group by all""",
            "by_month",
        ),
        "category_totals": _sql(
            f"""select crime_type, sum(total_crimes)::bigint as total_crimes from by_category
            where {_PICKED_TYPE} group by all""",
            "by_category",
        ),
        "heatmap_pivot": _sql(
            f"select crime_type, {heat} from by_category group by crime_type", "by_category"
        ),
        "force_outcome_long": _sql(
            " union all ".join(
                f"""select force, '{name}' as outcome, round(avg({name}), 6) as percentage
                from by_force where {_PICKED} group by force"""
                for name in ("pct_resolved", "pct_no_suspect", "pct_under_investigation")
            ),
            "by_force",
        ),
        "monthly_totals_by_force": _sql(
            "select month, force, count(*) as total_crimes from staged group by all", "staged"
        ),
        "monthly_quartiles_by_force": _sql(
            """select force, min(n) as minimum, quantile_cont(n, 0.25) as q1,
              quantile_cont(n, 0.5) as median, quantile_cont(n, 0.75) as q3, max(n) as maximum
            from (select month, force, count(*) as n from staged group by all) group by force""",
            "staged",
        ),
        "hotspot_markers_latest": _sql(
            """select lsoa_code, month, centroid_lat, centroid_lon,
              greatest(4.0::double, least(total_crimes / 3.0::double, 20.0::double)) as radius,
              case hotspot_tier when 'High' then 'red' when 'Medium' then 'orange'
                when 'Low' then 'green' else 'blue' end as colour,
              '<b>' || lsoa_name || '</b><br>Crimes: ' || total_crimes || '<br>Tier: '
                || hotspot_tier || '<br>Violence: ' || violence_count || '<br>Burglary: '
                || burglary_count as popup
            from hotspots where month = (select max(month) from hotspots)
              and centroid_lat is not null and centroid_lon is not null""",
            "hotspots",
        ),
        "outcome_modes": _sql(
            """select falls_within, month, last_outcome, occurrences from (
              select *, row_number() over (partition by falls_within, month
                order by occurrences desc, last_outcome) as n
              from (select falls_within, month, last_outcome, count(*) as occurrences from raw
                where last_outcome is not null group by all)
            ) where n = 1""",
            "raw",
        ),
        "value_counts_ranked": _sql(
            "select falls_within, month, rank::integer as rank, crime_type, incidents from shares",
            "shares",
        ),
        "category_distribution_100": _sql(
            "select falls_within, month, crime_type, pct::double as pct from shares", "shares"
        ),
        "top3_categories": _sql("select force, period, top_three from features", "features"),
        "month_on_month": _sql(
            "select force, period, total_crimes, previous_total, absolute, pct, direction from gapped_features",
            "gapped_features",
        ),
        "feature_rows": _sql(
            """select force, period, total_crimes, top_three, distribution, previous_total, absolute,
            pct, direction from gapped_features""",
            "gapped_features",
        ),
        "whole_table_features": _sql(
            """select
              (select falls_within from report_rows group by 1 order by count(*) desc, 1 limit 1)
                as force,
              (select month from report_rows group by 1 order by count(*) desc, 1 limit 1) as period,
              now as total_crimes,
              (select string_agg(crime_type, '|' order by n desc, crime_type) from (
                select crime_type, count(*) as n from report_rows group by 1
                order by n desc, crime_type limit 3)) as top_three,
              before as previous_total, now - before as absolute,
              round_even(abs(now - before)::double / before * 100, 1) as pct,
              case when now > before then 'increase' when now < before then 'decrease'
                else 'no change' end as direction
            from (select count(*) as now, count(*) filter (where last_outcome is null) as before
              from report_rows)""",
            "report_rows",
        ),
        "prompt_user_text": _sql("select force, period, user_text from prompts", "prompts"),
        "report_header_text": _sql(
            f"""select force, period, repeat('=', 62) || chr(10) || '  CRIME BRIEFING REPORT'
              || chr(10) || '  Force      : ' || force || chr(10) || '  Period     : ' || period
              || chr(10) || '  Total      : ' || format('{{:,}}', total_crimes) || ' crimes' || chr(10)
              || case direction when 'increase' then '  MoM Change : Increase '
                   when 'decrease' then '  MoM Change : Decrease '
                   when 'no change' then '  MoM Change : No Change ' else '' end
              || case when absolute is null then ''
                   else {_SIGNED} || ' (' || {_PCT} || ')' || chr(10) end as header
            from features""",
            "features",
        ),
        "report_json": _sql(
            """select force, period, '{"metadata":{"force":"' || force || '","period":"' || period
              || '","total_crimes":' || total_crimes || ',"generated_at":"2026-03-05T06:00:00.000000"}'
              || ',"source_statistics":{"top_categories":[' || top_json || '],"distribution":{'
              || share_json || '}' || case when previous_total is null then '' else
                ',"mom_change":{"previous_total":' || previous_total || ',"absolute":' || absolute
                || ',"pct":' || pct::decimal(30,1)::varchar || ',"direction":"' || direction || '"}' end
              || '},"report":"' || replace(user_text, chr(10), '\\n') || '"}' as json
            from prompts""",
            "prompts",
        ),
        "safe_stems": _sql(
            r"""select distinct last_outcome, month,
              replace(trim(regexp_replace(last_outcome, '[^\w\s-]', '', 'g')), ' ', '_') || '_'
                || regexp_replace(month, '[^\w-]', '', 'g') as stem
            from staged""",
            "staged",
        ),
        "incremental_new_rows": _sql(
            """select crime_id, month, force, crime_type, lsoa_code from batch b
            where not exists (select 1 from loaded r where r.crime_id = b.crime_id
              and r.month = b.month and r.force = b.force)""",
            "loaded",
            "batch",
        ),
        "incremental_reload_null_ids": _sql(
            """select month, count(*) + count(*) filter (where crime_id is null) as row_count,
              count(crime_id) as keyed_rows from keyed group by month""",
            "keyed",
        ),
        "load_counts": _sql(
            """select force, month, count(*) as inserted, count(*) filter (where crime_id is null) as keyless
            from keyed group by force, month""",
            "keyed",
        ),
        "warehouse_loads": _sql(
            """select 'first' as load_id, count(*) as inserted, count(*) filter (where crime_id is null) as keyless, count(*) as stored from loaded
            union all
            select 'second', count(*), count(*) filter (where crime_id is null), count(*) from batch b
            where not exists (select 1 from loaded r where r.crime_id = b.crime_id and r.month = b.month and r.force = b.force)
            union all
            select 'third', count(*), count(*), count(*) from batch where crime_id is null""",
            "loaded",
            "batch",
        ),
        "marks_after_gates": _sql(
            """select force, printf('%04d-%02d', (gap - 2) // 12, (gap - 2) % 12 + 1) as month
            from (
              select force, low, min(i) as gap
              from (select force, low, unnest(range(low, high + 2)) as i
                from (select force, min(n) as low, max(n) as high from numbered group by force)) u
              where i % (length(force) + 7) = 0
                or not exists (select 1 from numbered k where k.force = u.force and k.n = i)
              group by force, low
            ) where gap > low""",
            "numbered",
        ),
        "prompt_versions": _sql(
            " union all ".join(
                f"select '{version}' as version, force, period, {len(text)}::int as system_length from gapped_features"
                for version, text in SYSTEM_TEXT.items()
            ),
            "gapped_features",
        ),
        "rows_left_out": _sql(
            """select count(*) filter (where falls_within is null) as without_force,
              count(*) filter (where falls_within is not null and month is null) as without_month from gapped_rows""",
            "gapped_rows",
        ),
        "gate_require_rows": _sql("select 'staging' as model, count(*) as row_count from staged", "staged"),
        "latest_watermark": _sql(
            "select force, month, updated_at::timestamp::varchar as updated_at from marks", "marks"
        ),
        "pending_months": _sql(
            """select force, strftime(m, '%Y-%m') as month,
              strftime(m - interval 1 month, '%Y-%m') as previous
            from (select force, unnest(generate_series(
                (month || '-01')::timestamp + interval 1 month,
                ((select max(month) from staged) || '-01')::timestamp, interval 1 month)) as m
              from marks)""",
            "marks",
            "staged",
        ),
        "target_month": """
            select ts::date::varchar as run_date,
              strftime(date_trunc('month', ts) - interval 1 day, '%Y-%m') as target_month,
              count(*) as events
            from events group by 1, 2""",
        "partition_listing": _sql(
            """select distinct split_part(month, '-', 1) as part_year,
              split_part(month, '-', 2) as part_month, force from staged""",
            "staged",
        ),
        "gate_not_null": _sql(not_null, "by_category", "by_month", "by_force", "hotspots"),
        "gate_accepted_values": _sql(accepted, "hotspots"),
        "gate_min_rows": _sql(
            """select force, month, count(*) as row_count, count(*) >= 120 as passed
            from staged group by force, month""",
            "staged",
        ),
        "gate_loaded_pairs": _sql(
            """select distinct force, month from batch
            except select distinct force, month from loaded""",
            "loaded",
            "batch",
        ),
        "gate_month_format": _sql(
            r"""select force, count(month) as non_null,
              count(*) filter (where regexp_matches(month, '^\d{4}-\d{2}$')) as matching,
              case when count(*) filter (where regexp_matches(month, '^\d{4}-\d{2}$')) = 0 then 'error'
                when count(*) filter (where regexp_matches(month, '^\d{4}-\d{2}$'))
                  < 0.9 * count(month) then 'warn' else 'ok' end as status
            from (select force, case when force = 'europe'
                or (force = 'asia' and length(location) % 2 = 0)
                or (force = 'africa' and crime_type = 'Drugs' and length(location) % 2 = 0)
                then 'M' || month else month end as month from staged)
            group by force""",
            "staged",
        ),
        "gate_dropped_rows": _sql(
            """select falls_within, count(*) as row_count,
              count(*) filter (where crime_type is null) as dropped,
              round_even(count(*) filter (where crime_type is null)::double / count(*) * 100, 1)
                as dropped_pct
            from raw group by falls_within""",
            "raw",
        ),
    }
