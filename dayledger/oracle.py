"""The registered queries as plain SQL over the same tables, for comparison.

Written straight from the rules with window functions and joins: on purpose not the
way the Spark operators compute them.
"""

from __future__ import annotations

_BASE = """
k as (
  select l_partkey as pk, dayofyear(l_shipdate) % 95 as di,
         sum(cast(l_quantity as bigint)) as q, sum(cast(l_linenumber as bigint)) as ln,
         sum(cast(l_extendedprice as decimal(18,2))) as price
  from lineitem group by l_partkey, dayofyear(l_shipdate) % 95),
h as (
  select *, (pk*7919 + di*104729 + ln*31) % 10000 as h, (pk*613 + di*389 + q) % 250 as g from k),
truth as (
  select pk, cast(di as int) as day_idx, date '2026-01-01' + cast(di as int) as event_date,
    'cmp_' || cast(pk % 25 as varchar) as campaign_id,
    'cmp_' || cast(pk % 25 as varchar) || '_adset_' || cast(pk % 3 as varchar) as adset_id,
    'cr_' || cast(pk as varchar) as creative_id,
    case pk % 4 when 0 then 'video' when 1 then 'still' when 2 then 'slides' else 'grid' end as creative_format,
    case pk % 5 when 0 then 'main' when 1 then 'top' when 2 then 'side' when 3 then 'partner' else 'inline' end as placement,
    cast(case when h % 33 = 0 then 0 else q * 100 end as bigint) as impressions,
    cast(case when h % 33 = 0 then 0 else q * (1 + h % 7) end as bigint) as clicks,
    cast(price as double) as spend,
    cast(case when h % 33 = 0 then 0 else h % 4 end as bigint) as conversions, h, g
  from h),
d as (
  select t.*, case when h % 100 < 90 then 0 when h % 100 < 96 then 1 when h % 100 < 99 then 2 else 3 end as delay,
         case when g between 20 and 32 then 1 + g % 2 else 0 end as corr from truth t),
v as (
  select pk, day_idx, day_idx + delay as drop_idx, 0 as copy, event_date, campaign_id, adset_id, creative_id, creative_format, placement,
    case when g = 2 then null when corr > 0 then impressions * 2 else impressions end as impressions,
    case when g = 3 then null when g = 5 and impressions > 0 then impressions + 1 when corr > 0 then clicks * 2 else clicks end as clicks,
    case when g = 4 then null when corr > 0 then spend * 2 else spend end as spend,
    case when g = 6 then null when corr > 0 then conversions * 2 else conversions end as conversions from d
  union all select pk, day_idx, day_idx + delay + corr, 1, event_date, campaign_id, adset_id, creative_id, creative_format, placement, impressions, clicks, spend, conversions from d where corr > 0
  union all select pk, day_idx, day_idx + delay, 2, event_date, campaign_id, adset_id, creative_id, creative_format, placement, impressions, clicks, spend, conversions from d where g = 0
  union all select pk, day_idx, day_idx + delay, 3, event_date, campaign_id, adset_id, creative_id, creative_format, placement, impressions + 37, clicks, spend, conversions from d where g = 1),
raw as (
  select event_date as date, campaign_id, adset_id, creative_id, creative_format, placement,
    cast(impressions as double) as impressions, cast(clicks as double) as clicks, spend,
    cast(conversions as double) as conversions,
    case when drop_idx >= 50 and creative_format = 'video' then cast(0.5 as double) end as video_completion_rate,
    'drop_' || cast(date '2026-01-01' + cast(drop_idx as int) as varchar) || '.csv' as _source_file,
    date '2026-01-01' + cast(drop_idx as int) as _drop_date,
    cast((pk * 95 + day_idx) * 4 + copy as bigint) as _row_in_file
  from v where drop_idx <> 70)"""


def _staged(name: str, source: str) -> str:
    return f"""
{name}_last as (
  select distinct on (date, campaign_id, adset_id, creative_id) * from {source}
  order by date, campaign_id, adset_id, creative_id, _drop_date desc nulls last, _row_in_file desc),
{name}_copies as (
  select date, campaign_id, adset_id, creative_id, _drop_date, count(*) as copies
  from {source} group by all),
{name} as (
  select date as event_date, campaign_id, adset_id, creative_id, creative_format, placement,
         cast(impressions as bigint) as impressions, cast(clicks as bigint) as clicks, spend,
         cast(conversions as bigint) as conversions, video_completion_rate,
         _drop_date as loaded_from_drop_date, _source_file as loaded_from_file,
         copies >= 2 as had_same_drop_duplicate
  from {name}_last join {name}_copies using (date, campaign_id, adset_id, creative_id, _drop_date))"""


_STAGED = _staged("staged", "raw")

_FACT = """
budget as (
  select campaign_id, event_date, cast(sum(cast(spend as decimal(18,2))) as double) as total
  from staged group by campaign_id, event_date),
contest as (
  select event_date, campaign_id, adset_id, creative_id,
    rank() over (partition by event_date, campaign_id
                 order by cast(clicks as double) / impressions desc nulls last) as place,
    count(*) over (partition by event_date, campaign_id) as entrants
  from staged where impressions >= 1000),
placed as (
  select staged.*, total, case when entrants = 1 then 0 else (place - 1) / cast(entrants - 1 as double) end as pct
  from staged join budget using (event_date, campaign_id)
    left join contest using (event_date, campaign_id, adset_id, creative_id)),
fact as (
  select md5(concat_ws('-', event_date, creative_id)) as creative_daily_id,
    event_date, campaign_id, adset_id, creative_id, creative_format, placement,
    impressions, clicks, spend, conversions, video_completion_rate, had_same_drop_duplicate,
    case when impressions <> 0 then cast(clicks as double) / impressions end as ctr,
    case when clicks <> 0 then spend / clicks end as cpc,
    case when conversions <> 0 then spend / conversions end as cpa,
    case when clicks <> 0 then cast(conversions as double) / clicks end as conversion_rate,
    case when total <> 0 then spend / total end as spend_share,
    not impressions < 1000 as meets_volume_floor,
    cast(pct as double) as ctr_percentile_in_campaign_day,
    pct is not null and pct <= 0.1 as is_top_decile_creative
  from placed),
dim as (
  select creative_id, min(campaign_id) as campaign_id, min(adset_id) as adset_id,
    min(creative_format) as creative_format, min(placement) as placement,
    min(event_date) as first_seen_date, max(event_date) as last_seen_date
  from staged group by creative_id)"""

_CLOCK = """
clock as (
  select max(_drop_date) as today, cast(max(_drop_date) - interval 7 day as date) as final_day from raw)"""

_TOP = """
top as (
  select campaign_id, creative_id, creative_format, placement, impressions, clicks,
    cast(round(cast(ctr as decimal(38,10)), 4) as double) as ctr
  from fact, clock where event_date = final_day and is_top_decile_creative)"""

_RECON = """
recent as (select cast(max(event_date) - interval 7 day as date) as since from fact),
wanted as (
  select event_date, creative_id,
    row(impressions, clicks, round(cast(spend as decimal(38,10)), 2), conversions) as numbers
  from truth where event_date >= (select since from recent)),
found as (
  select event_date, creative_id, had_same_drop_duplicate or coalesce(clicks > impressions, true) as spoilt,
    impressions + clicks + conversions + spend is null as partly_blank,
    row(impressions, clicks, round(cast(spend as decimal(38,10)), 2), conversions) as numbers
  from fact where event_date >= (select since from recent)),
recon as (
  select event_date, creative_id, 'missing_from_fct' as issue
  from wanted anti join found using (event_date, creative_id)
  union all
  select event_date, creative_id, 'value_mismatch'
  from found join wanted using (event_date, creative_id)
  where not (spoilt or partly_blank) and found.numbers is distinct from wanted.numbers)"""

_DEFECTS = """
per_drop as (
  select date, campaign_id, adset_id, creative_id, _drop_date, impressions, clicks, spend, conversions
  from (select *, row_number() over (partition by date, campaign_id, adset_id, creative_id, _drop_date
                                     order by _row_in_file desc) as rn from raw)
  where rn = 1),
late as (
  select 'late_arrival' as defect_type, date as event_date, min(_drop_date) as drop_date,
    campaign_id, adset_id, creative_id, min(_drop_date) - date as delayed_by_days
  from raw group by date, campaign_id, adset_id, creative_id having min(_drop_date) > date),
restated as (
  select 'restatement' as defect_type, b.date as event_date, b._drop_date as drop_date,
    b.campaign_id, b.adset_id, b.creative_id, a._drop_date as original_drop_date
  from per_drop b join per_drop a
    on a.date = b.date and a.campaign_id = b.campaign_id and a.adset_id = b.adset_id and a.creative_id = b.creative_id
   and a._drop_date = (select max(c._drop_date) from per_drop c
                       where c.date = b.date and c.campaign_id = b.campaign_id and c.adset_id = b.adset_id
                         and c.creative_id = b.creative_id and c._drop_date < b._drop_date)
  where a.impressions is distinct from b.impressions or a.clicks is distinct from b.clicks
     or a.spend is distinct from b.spend or a.conversions is distinct from b.conversions),
exact as (
  select 'duplicate_exact' as defect_type, date as event_date, _drop_date as drop_date,
    campaign_id, adset_id, creative_id, count(*) as copies
  from raw
  group by date, campaign_id, adset_id, creative_id, creative_format, placement, impressions, clicks,
    spend, conversions, video_completion_rate, _drop_date
  having count(*) > 1),
near_groups as (
  select date as event_date, _drop_date as drop_date, campaign_id, adset_id, creative_id,
    count(distinct coalesce(cast(impressions as varchar), 'none')) > 1 as v1,
    count(distinct coalesce(cast(clicks as varchar), 'none')) > 1 as v2,
    count(distinct coalesce(cast(spend as varchar), 'none')) > 1 as v3,
    count(distinct coalesce(cast(conversions as varchar), 'none')) > 1 as v4
  from raw group by date, _drop_date, campaign_id, adset_id, creative_id),
near as (
  select 'duplicate_near' as defect_type, event_date, drop_date, campaign_id, adset_id, creative_id,
    concat_ws(',', case when v1 then 'impressions' end, case when v2 then 'clicks' end,
              case when v3 then 'spend' end, case when v4 then 'conversions' end) as jittered_field
  from near_groups where v1 or v2 or v3 or v4),
blank as (
  select 'null_value' as defect_type, date as event_date, _drop_date as drop_date, campaign_id, adset_id,
    creative_id, field
  from (select *, 'impressions' as field from raw where impressions is null
        union all select *, 'clicks' from raw where clicks is null
        union all select *, 'spend' from raw where spend is null
        union all select *, 'conversions' from raw where conversions is null)),
impossible as (
  select 'clicks_exceed_impressions' as defect_type, date as event_date, _drop_date as drop_date,
    campaign_id, adset_id, creative_id, cast(impressions as bigint) as impressions,
    cast(clicks as bigint) as clicks
  from raw where clicks > impressions),
absent as (
  select 'missing_day' as defect_type, cast(day as date) as event_date, cast(day as date) as drop_date,
    cast(null as varchar) as campaign_id, cast(null as varchar) as adset_id, cast(null as varchar) as creative_id
  from (select unnest(generate_series(min(_drop_date), max(_drop_date), interval 1 day)) as day from raw)
  where cast(day as date) not in (select _drop_date from raw)),
layouts as (
  select _drop_date, case when count(video_completion_rate) > 0 then 'late' else 'early' end as layout
  from raw group by _drop_date
  having count(video_completion_rate) > 0 or count(*) filter (creative_format = 'video') > 0),
drift as (
  select 'schema_drift' as defect_type, _drop_date as event_date, _drop_date as drop_date,
    cast(null as varchar) as campaign_id, cast(null as varchar) as adset_id, cast(null as varchar) as creative_id,
    before as from_layout, layout as to_layout
  from (select *, lag(layout) over (order by _drop_date) as before from layouts) where before <> layout)"""

_ALL_DEFECTS = """select defect_type from late union all select defect_type from restated
  union all select defect_type from exact union all select defect_type from near
  union all select defect_type from blank union all select defect_type from impossible
  union all select defect_type from absent union all select defect_type from drift"""

_MID_HISTORY = """
mid_raw as (select * from raw where _drop_date <= date '2026-03-25'),""" + _staged("staged", "mid_raw")

_INCREMENTAL = (
    """
early_raw as (select * from raw where _drop_date <= date '2026-03-25'),"""
    + _staged("target", "early_raw")
    + """,
lookback as (select cast(max(event_date) - interval 7 day as date) as start from target),
recent_raw as (select raw.* from raw, lookback where date >= start),"""
    + _staged("recomputed", "recent_raw")
)

_LOADED_COLUMNS = "from (select _source_file as file_name, count(*) as row_count from raw group by _source_file)"


def _with(*parts: str, select: str) -> str:
    return "with" + ",".join((_BASE, *parts)) + "\n" + select.strip()


def _fact_query(select: str) -> str:
    return _with(_STAGED, _FACT, select=select)


def _defect_query(select: str) -> str:
    return _with(_DEFECTS, select=select)


_KEY = "event_date, campaign_id, adset_id, creative_id"

ORACLE: dict[str, str] = {
    "deliveries": _with(select="select * from raw"),
    "staging_dedup": _with(_STAGED, select="select * from staged"),
    "same_drop_duplicates": _with(
        select="""select date as event_date, campaign_id, adset_id, creative_id, _drop_date,
            count(*) as same_drop_key_count
          from raw group by all having count(*) > 1"""
    ),
    "dim_creative": _fact_query("select * from dim"),
    "dimension_conflicts": _with(
        _STAGED,
        select="""select * from (
            select creative_id, count(distinct campaign_id) > 1 as campaign_id_varies,
              count(distinct adset_id) > 1 as adset_id_varies,
              count(distinct creative_format) > 1 as creative_format_varies,
              count(distinct placement) > 1 as placement_varies
            from staged group by creative_id)
          where campaign_id_varies or adset_id_varies or creative_format_varies or placement_varies""",
    ),
    "adset_conflicts": _with(
        _STAGED,
        select="""select * from (
            select adset_id, count(distinct campaign_id) > 1 as campaign_id_varies,
              false as adset_id_varies,
              count(distinct creative_format) > 1 as creative_format_varies,
              count(distinct placement) > 1 as placement_varies
            from staged group by adset_id)
          where campaign_id_varies or creative_format_varies or placement_varies""",
    ),
    "entity_counts": _with(
        _STAGED,
        select="""select count(distinct campaign_id) as campaigns, count(distinct adset_id) as adsets,
            count(distinct creative_id) as creatives from staged""",
    ),
    "creative_daily_metrics": _fact_query(
        f"select {_KEY}, ctr, cpc, cpa, conversion_rate, meets_volume_floor from fact"
    ),
    "spend_share": _fact_query(f"select {_KEY}, spend, spend_share from fact"),
    "ctr_percentile": _fact_query(
        f"select {_KEY}, ctr, meets_volume_floor, ctr_percentile_in_campaign_day from fact"
    ),
    "ctr_percentile_hot_groups": _fact_query(
        f"""select {_KEY}, spend_share, ctr_percentile_in_campaign_day, is_top_decile_creative
          from fact"""
    ),
    "top_decile": _fact_query(
        """select event_date, campaign_id, creative_id, ctr, ctr_percentile_in_campaign_day
          from fact where is_top_decile_creative"""
    ),
    "creative_daily_fact": _fact_query("select * from fact"),
    "finalized_top_decile": _with(
        _STAGED, _FACT, _CLOCK, _TOP,
        select="select * from top order by campaign_id, ctr desc nulls last, creative_id",
    ),
    "display_top_decile": _with(
        _STAGED, _FACT, _CLOCK, _TOP,
        select="""select campaign_id, creative_id, creative_format, placement,
            format('{:,}', impressions) as impressions, format('{:,}', clicks) as clicks,
            printf('%.2f', ctr * 100) || '%' as ctr
          from top""",
    ),
    "freshness": _with(
        _STAGED, _FACT, _CLOCK, _TOP,
        select="""select today, (select max(event_date) from fact) as latest_available_day,
            final_day as latest_finalized_day, cast(today - final_day as int) as lag_days,
            7 as lookback_days, (select count(distinct _source_file) from raw) as loaded_files,
            cast(0 as bigint) as quarantined_files, 'ok' as files_status,
            (select count(*) from top) as top_creatives
          from clock""",
    ),
    "file_status": _with(
        select="""select 'loaded' as status, count(distinct _source_file) as files, count(*) as rows from raw"""
    ),
    "drop_file_names": _with(
        select=f"""select file_name,
            try_cast(nullif(regexp_extract(file_name, '^drop_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv$', 1), '') as date) as drop_date,
            cast(null as date) as other_name_date, row_count {_LOADED_COLUMNS}"""
    ),
    "lookback_window": _with(
        _INCREMENTAL, select="select date as event_date, count(*) as rows from recent_raw group by date"
    ),
    "incremental_staging": _with(
        _INCREMENTAL,
        select="""select * from target where event_date < (select start from lookback)
          union all select * from recomputed""",
    ),
    "clicks_exceed_impressions": _fact_query(
        """select creative_daily_id, event_date, creative_id, impressions, clicks
          from fact where clicks > impressions"""
    ),
    "reconciliation": _with(_STAGED, _FACT, _RECON, select="select * from recon"),
    "reconciliation_mid_history": _with(_MID_HISTORY, _FACT, _RECON, select="select * from recon"),
    "unexpected_in_fact": _fact_query(
        """select event_date, creative_id from fact f where not exists (
            select 1 from truth t where t.event_date = f.event_date and t.creative_id = f.creative_id
              and t.event_date < date '2026-03-25')"""
    ),
    "unique_creative_days": _fact_query(
        """select creative_daily_id, count(*) as rows from fact where creative_daily_id is not null
          group by creative_daily_id having count(*) > 1"""
    ),
    "repeated_deliveries": _with(
        select="""select md5(cast(date as varchar) || '-' || creative_id) as creative_daily_id,
            count(*) as rows
          from raw group by 1 having count(*) > 1"""
    ),
    "orphan_creatives": _fact_query(
        """select creative_id, count(*) as rows from fact where creative_id not in (
            select creative_id from raw where _drop_date <= date '2026-01-03')
          group by creative_id"""
    ),
    "check_results": _with(
        _STAGED, _FACT, _RECON,
        select="""
          select check_name, severity, failures,
            case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
          from (
            select 'not_null_fct_creative_daily_id' as check_name, 'error' as severity,
              (select count(*) from fact where creative_daily_id is null) as failures
            union all select 'not_null_fct_event_date', 'error', (select count(*) from fact where event_date is null)
            union all select 'not_null_fct_campaign_id', 'error', (select count(*) from fact where campaign_id is null)
            union all select 'not_null_fct_creative_id', 'error', (select count(*) from fact where creative_id is null)
            union all select 'not_null_dim_creative_id', 'error', (select count(*) from dim where creative_id is null)
            union all select 'clicks_lte_impressions', 'warn', (select count(*) from fact where clicks > impressions)
            union all select 'unique_fct_creative_daily_id', 'error', (select count(*) from (
              select 1 from fact group by creative_daily_id having count(*) > 1))
            union all select 'unique_dim_creative_id', 'error', (select count(*) from (
              select 1 from dim group by creative_id having count(*) > 1))
            union all select 'relationships_fct_creative_id', 'error', (select count(*) from fact
              where creative_id not in (select creative_id from dim))
            union all select 'reconciliation_within_lookback', 'error', (select count(*) from recon))""",
    ),
    "gap_split": _fact_query(
        """select t.event_date = date '2026-03-12' as on_outage_day, count(*) as lost_rows
          from truth t where not exists (
            select 1 from fact f where f.event_date = t.event_date and f.creative_id = t.creative_id)
          group by t.event_date = date '2026-03-12'"""
    ),
    "floor_calibration": _fact_query(
        """select quantile_cont(cast(impressions as double), 0.1) as impressions_p10,
            count(impressions) as creative_days, count(*) filter (meets_volume_floor) as eligible_days,
            count(*) filter (meets_volume_floor) / cast(count(impressions) as double) as eligible_share
          from fact"""
    ),
    "flagged_share": _fact_query(
        """select group_size, count(*) as campaign_days, cast(sum(flagged) as bigint) as flagged,
            cast(sum(flagged) as double) / (group_size * count(*)) as flagged_share
          from (select campaign_id, event_date, count(*) as group_size,
                  count(*) filter (is_top_decile_creative) as flagged
                from fact where meets_volume_floor group by campaign_id, event_date)
          group by group_size"""
    ),
    "defect_late_arrival": _defect_query("select * replace (cast(delayed_by_days as int) as delayed_by_days) from late"),
    "defect_restatement": _defect_query("select * from restated"),
    "defect_duplicate_exact": _defect_query("select * from exact"),
    "defect_duplicate_near": _defect_query("select * from near"),
    "defect_null_value": _defect_query("select * from blank"),
    "defect_clicks_exceed_impressions": _defect_query("select * from impossible"),
    "defect_missing_day": _defect_query("select * from absent"),
    "defect_schema_drift": _defect_query("select * from drift"),
    "defect_counts": _defect_query(
        f"""select defect_type, count(*) as defects, replace(defect_type, '_', ' ') as label
          from ({_ALL_DEFECTS}) group by defect_type"""
    ),
    "snapshot_document": _with(
        _STAGED, _FACT, _CLOCK, _TOP, _DEFECTS,
        select=f"""
          select '{{"today":"' || today || '","latest_available_day":"' || (select max(event_date) from fact)
            || '","latest_finalized_day":"' || final_day || '","lookback_days":7,"loaded_files":'
            || (select count(distinct _source_file) from raw) || ',"quarantined_files":0,"defect_counts":{{'
            || (select string_agg('"' || defect_type || '":' || n, ',' order by defect_type)
                from (select defect_type, count(*) as n from ({_ALL_DEFECTS}) group by defect_type))
            || '}}, "top_decile_by_campaign": [' as value
          from clock
          union all
          select case when row_number() over (order by campaign_id, ctr desc nulls last, creative_id) = 1
              then ' ' else ',' end
            || '{{"campaign_id":"' || campaign_id || '","creative_id":"' || creative_id
            || '","creative_format":"' || creative_format || '","placement":"' || placement
            || '","impressions":' || impressions || ',"clicks":' || clicks || ',"ctr":' || ctr || '}}'
          from top
          union all select ']}}'""",
    ),
    "ingested_deliveries": _with(
        select="""select date, campaign_id, adset_id, creative_id, creative_format, placement,
            impressions, clicks, spend, conversions, video_completion_rate from raw"""
    ),
    "ingested_by_layout": _with(
        select="""select 'loaded' as status,
            case when _drop_date < date '2026-02-20' then 'early' else 'late' end as layout,
            cast(count(*) as bigint) as rows, min(date) as first_event_date, max(date) as last_event_date
          from raw group by 2
          union all select 'quarantined', null, 0, null, null"""
    ),
    "quarantined_lines": _with(
        select="""select cast(date as varchar) || ',' || creative_id || ',' || cast(clicks as varchar) as line
          from raw where clicks > impressions"""
    ),
    "streamed_creative_days": _with(
        select="""select date as event_date, count(*) as creative_days
          from (select distinct date, campaign_id, adset_id, creative_id from raw) group by date"""
    ),
    "check_violations": _with(
        _MID_HISTORY, _FACT, _RECON,
        select="""select 'clicks_lte_impressions' as check_name, 'warn' as severity, cast(1 as bigint) as failures,
            event_date, creative_id, cast(null as varchar) as issue
          from fact where clicks > impressions
          union all
          select 'relationships_fct_creative_id', 'error', count(*), null, creative_id, null
          from fact where creative_id not in (select creative_id from raw where _drop_date <= date '2026-01-03')
          group by creative_id
          union all
          select 'reconciliation_within_lookback', 'error', 1, event_date, creative_id, issue from recon""",
    ),
    "raw_lineage": _with(
        select="""select * replace (
            row_number() over (partition by _source_file order by _row_in_file) - 1 as _row_in_file) from raw"""
    ),
    "second_run_log": _with(
        select="""select _source_file as file_name, 'loaded' as status, count(*) as row_count,
            '' as reason, _drop_date as drop_date,
            case when _drop_date < date '2026-02-20' then 'early' else 'late' end as layout,
            min(date) as first_event_date, max(date) as last_event_date
          from raw group by _source_file, _drop_date"""
    ),
    "stored_incremental_staging": _with(
        _INCREMENTAL,
        select="""select * from target where event_date < (select start from lookback)
          union all select * from recomputed""",
    ),
    "defect_log_replay": _with(
        _DEFECTS,
        select=" union all ".join(
            f"select defect_type, event_date, drop_date, campaign_id, adset_id, creative_id from {kind}"
            for kind in ("late", "restated", "exact", "near", "blank", "impossible", "absent", "drift")
        ),
    ),
    "streamed_staging": _with(
        _INCREMENTAL,
        select="""select * from target where event_date < (select start from lookback)
          union all select * from recomputed""",
    ),
    "freshness_after_loads": _with(
        _STAGED, _FACT, _CLOCK, _TOP,
        select="""select today, (select max(event_date) from fact) as latest_available_day,
            final_day as latest_finalized_day, cast(today - final_day as int) as lag_days,
            7 as lookback_days, (select count(distinct _source_file) from raw) as loaded_files,
            cast(1 as bigint) as quarantined_files, 'warn' as files_status,
            (select count(*) from top) as top_creatives
          from clock""",
    ),
    "header_schema_drift": _defect_query("select * from drift"),
    "reconciliation_from_file": _with(_MID_HISTORY, _FACT, _RECON, select="select * from recon"),
    "run_counts": _with(
        select="""
          select cast(0 as int) as run, cast(0 as int) as skipped,
            cast(count(distinct _source_file) as int) as loaded, cast(0 as int) as quarantined,
            count(*) as rows_loaded, cast(null as date) as start, count(*) as rows_in,
            count(distinct (date, campaign_id, adset_id, creative_id)) as rows_out
          from raw where _drop_date <= date '2026-03-25'
          union all
          select 1, (select cast(count(distinct _source_file) as int) from raw where _drop_date <= date '2026-03-25'),
            (select cast(count(distinct _source_file) as int) from raw where _drop_date > date '2026-03-25'), 0,
            (select count(*) from raw where _drop_date > date '2026-03-25'), since,
            (select count(*) from raw where date >= since),
            (select count(distinct (date, campaign_id, adset_id, creative_id)) from raw where date >= since)
          from (select cast(max(date) - interval 7 day as date) as since from raw where _drop_date <= date '2026-03-25')"""
    ),
}
