"""Link-selection queries (L1-L5) over hrefs harvested from ``pages``.

fx_hrefs keeps each page's anchors and rewrites some positions into PTP-style
download links (full-table parts behind the license wrapper, delta zips,
Medicaid zips with either date order, relative and absolute), so every branch
of the selection runs on data that grows with the pages table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import links as L
from regloom.plans.registry import register
from regloom.sources.tables import Tables


def fx_hrefs(pages: DataFrame) -> DataFrame:
    h = L.page_hrefs(pages)
    p, i = F.col("page_id"), F.col("href_pos")
    s = lambda c: c.cast("string")
    full = F.concat(
        F.lit("/license/ama?file=/files/zip//medicare-ncci-"), s(2024 + (p + i) % 3), F.lit("q"), s(1 + i % 4),
        F.lit("-practitioner-ptp-edits-ccipra-v32"), s(i % 2), F.lit("r0-f"), s(1 + i % 3), F.lit(".zip"),
    )
    delta = F.concat(
        F.lit("/files/zip/medicare-ncci-"), s(2024 + p % 3), F.lit("q2-practitioner-quarterly-additions-deletions-revisions-ptp.zip")
    )
    mcd = F.concat(
        F.lit("/files/zip/medicaid-ncci-"), s(2024 + i % 3), F.lit("-q"), s(1 + p % 4), F.lit("-ptp-edits-"),
        F.when(p % 3 == 0, F.lit("durable-medical-equipment")).otherwise(F.lit("practitioner-services")), F.lit(".zip"),
    )
    mcd_rel = F.concat(F.lit("medicaid-ncci-q"), s(1 + i % 4), F.lit("-"), s(2025 + p % 2), F.lit("-ptp-edits-practitioner-services.zip"))
    href = (
        F.when((i % 5 == 0) & (p % 4 != 0), full)
        .when((i % 5 == 1) & (p % 8 != 0), delta)
        .when(i % 5 == 2, mcd)
        .when((i % 5 == 3) & (p % 2 == 0), mcd_rel)
        .otherwise(F.col("href"))
    )
    return h.select("page_id", "base_url", "href_pos", href.alias("href"))


FX_HREFS_SQL = r"""
with raw as (
  select page_id, url as base_url, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1) as hs from pages),
ex as (
  select page_id, base_url, cast(generate_subscripts(hs, 1) - 1 as integer) as href_pos, unnest(hs) as href0 from raw),
fx_hrefs as (
  select page_id, base_url, href_pos,
    case
      when href_pos % 5 = 0 and page_id % 4 <> 0 then '/license/ama?file=/files/zip//medicare-ncci-'
           || cast(2024 + (page_id + href_pos) % 3 as varchar) || 'q' || cast(1 + href_pos % 4 as varchar)
           || '-practitioner-ptp-edits-ccipra-v32' || cast(href_pos % 2 as varchar) || 'r0-f'
           || cast(1 + href_pos % 3 as varchar) || '.zip'
      when href_pos % 5 = 1 and page_id % 8 <> 0 then '/files/zip/medicare-ncci-' || cast(2024 + page_id % 3 as varchar)
           || 'q2-practitioner-quarterly-additions-deletions-revisions-ptp.zip'
      when href_pos % 5 = 2 then '/files/zip/medicaid-ncci-' || cast(2024 + href_pos % 3 as varchar) || '-q'
           || cast(1 + page_id % 4 as varchar) || '-ptp-edits-'
           || case when page_id % 3 = 0 then 'durable-medical-equipment' else 'practitioner-services' end || '.zip'
      when href_pos % 5 = 3 and page_id % 2 = 0 then 'medicaid-ncci-q' || cast(1 + href_pos % 4 as varchar) || '-'
           || cast(2025 + page_id % 2 as varchar) || '-ptp-edits-practitioner-services.zip'
      else href0 end as href
  from ex)
"""


def _join_sql(base: str, h: str) -> str:
    origin = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
    no_query = f"regexp_replace(regexp_replace({base}, '#.*$', ''), '\\?.*$', '')"
    dir_ = (
        f"(case when regexp_extract({no_query}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)(/.*)?$', 2) = '' "
        f"then {origin} || '/' else regexp_extract({no_query}, '^(.*/)', 1) end)"
    )
    return (
        f"(case when {h} = '' then {base} "
        f"when regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') then {h} "
        f"when {h} like '//%' then regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || {h} "
        f"when {h} like '/%' then {origin} || {h} "
        f"when {h} like '?%' then {no_query} || {h} "
        f"when {h} like '#%' then regexp_replace({base}, '#.*$', '') || {h} "
        f"else regexp_replace({dir_} || {h}, '/\\./', '/', 'g') end)"
    )


def _unwrap_sql(h: str) -> str:
    target = f"url_decode(regexp_extract({h}, '[?&]file=([^&#]*)', 1))"
    return (
        f"(case when regexp_extract({h}, '^([^?#]*)', 1) like '%/license/ama' and {target} <> '' "
        f"then regexp_replace({target}, '/{{2,}}', '/', 'g') else {h} end)"
    )


def _resolve_sql(h: str, base: str) -> str:
    return _join_sql(base, _unwrap_sql(h))


_FULL_RE = "(?i)" + L.RE_FULL_PRACTITIONER


@register(
    "ncci_full_table_parts",
    covers=("L1", "L5"),
    oracle=FX_HREFS_SQL.rstrip()
    + f""",
m as (
  select page_id, base_url, href_pos, href,
         cast(regexp_extract(href, '{_FULL_RE}', 1) as bigint) as y, cast(regexp_extract(href, '{_FULL_RE}', 2) as bigint) as q,
         cast(regexp_extract(href, '{_FULL_RE}', 3) as bigint) as vmaj, cast(regexp_extract(href, '{_FULL_RE}', 4) as bigint) as vmin,
         cast(regexp_extract(href, '{_FULL_RE}', 5) as bigint) as part
  from fx_hrefs where regexp_matches(href, '{_FULL_RE}')),
best as (select page_id, max((y, q, vmaj, vmin)) as b from m group by page_id),
chosen as (select m.* from m join best using (page_id) where (y, q, vmaj, vmin) = b),
firsts as (select *, row_number() over (partition by page_id, part order by href_pos) as rn from chosen)
select page_id, part, href_pos, {_resolve_sql('href', 'base_url')} as url from firsts where rn = 1""",
)
def q_full_parts(spark, sf_dir):
    return L.full_table_parts(fx_hrefs(Tables(spark, sf_dir).pages))


@register(
    "ncci_delta_fallback",
    covers=("L2",),
    oracle=FX_HREFS_SQL.rstrip()
    + f""",
full_pages as (select distinct page_id from fx_hrefs where regexp_matches(href, '{_FULL_RE}')),
missing as (select distinct page_id from fx_hrefs where page_id not in (select page_id from full_pages)),
d as (select page_id, base_url, href, row_number() over (partition by page_id order by href_pos) as rn
      from fx_hrefs where regexp_matches(href, '(?i){L.RE_DELTA_PRACTITIONER}')),
firsts as (select * from d where rn = 1)
select missing.page_id,
       case when firsts.href is null then 'none' else 'delta' end as table_scope,
       case when firsts.href is not null then {_join_sql('firsts.base_url', 'firsts.href')} end as url,
       case when firsts.href is null then '{L.NO_LINK_WARNING}' else '{L.DELTA_WARNING}' end as warning
from missing left join firsts using (page_id)""",
)
def q_delta_fallback(spark, sf_dir):
    h = fx_hrefs(Tables(spark, sf_dir).pages)
    return L.delta_fallback(h)


@register(
    "medicaid_ptp_zips",
    covers=("L3", "L4", "L5"),
    oracle=FX_HREFS_SQL.rstrip()
    + f""",
m as (
  select page_id, href_pos,
         coalesce(try_cast(nullif(regexp_extract(href, '(20\\d{{2}})', 1), '') as integer), 0) as y,
         coalesce(try_cast(nullif(regexp_extract(href, '(?i)q([1-4])', 1), '') as integer), 0) as q,
         {_resolve_sql('href', 'base_url')} as url
  from fx_hrefs
  where lower(href) like '%medicaid%' and lower(href) like '%ptp%' and lower(href) like '%practitioner%'
    and not regexp_matches(lower(href), '\\bmue\\b') and lower(href) not like '%outpatient%'
    and lower(href) not like '%hospital%' and lower(href) not like '%durable%'
    and not regexp_matches(lower(href), '\\bdme\\b') and regexp_matches(href, '(?i).*\\.zip')),
best as (select page_id, max((y, q)) as b from m group by page_id)
select page_id, url, min(href_pos) as first_pos
from m join best using (page_id) where (y, q) = b group by page_id, url""",
)
def q_medicaid_zips(spark, sf_dir):
    return L.medicaid_zips(fx_hrefs(Tables(spark, sf_dir).pages))
