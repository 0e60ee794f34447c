"""PTP table jobs (E7, E8) over many pages: links of ``pages``, rows of ``part``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import extract as X
from regloom.operators import links as L
from regloom.operators import markup as MK
from regloom.operators import ncci
from regloom.plans.q_links import _FULL_RE, FX_HREFS_SQL, _join_sql, _resolve_sql, fx_hrefs
from regloom.plans.q_ptp import _STAGED_SQL, raw_rows
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

#: Files that a row of ``part`` is dealt to, by the first hexadecimal digits of the hash of the file's URL.
DEALT = 256


def fx_payloads(urls: DataFrame) -> DataFrame:
    """Fetched files: a URL whose hash ends in 0 was not fetched, one that ends in 1 gave no zip."""
    h = F.sha2("url", 256)
    last = F.substring(h, -1, 1)
    return urls.select("url").distinct().where(last != "0").select("url", F.sha2(h, 256).alias("digest"), (last != "1").alias("is_zip"))


def fx_file_rows(urls: DataFrame, part: DataFrame) -> DataFrame:
    """Every file holds the rows of ``part`` whose key modulo DEALT its URL's hash begins with."""
    bucket = F.conv(F.substring(F.sha2("url", 256), 1, 2), 16, 10).cast("bigint")
    files = urls.select("url", bucket.alias("_bucket")).distinct()
    rows = raw_rows(part).drop("part_ord").withColumn("_bucket", F.col("row_ord") % DEALT)
    # Few bytes go into this join and many rows come out: a number of partitions is named, or they would be coalesced by what goes in.
    parts = min(DEALT, int(part.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(parts, "_bucket").join(rows.repartition(parts, "_bucket"), "_bucket").drop("_bucket")


def _inputs(spark, sf_dir, chosen) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    t = Tables(spark, sf_dir)
    hrefs = fx_hrefs(t.pages)
    urls = chosen(hrefs)
    return hrefs, fx_payloads(urls), fx_file_rows(urls, t.part), t.pages


def _medicare(spark, sf_dir) -> ncci.TableJobs:
    def urls(h):
        return L.full_table_parts(h).select("url").unionByName(L.delta_fallback(h).where("url is not null").select("url"))

    return ncci.medicare_tables(*_inputs(spark, sf_dir, urls))


def _medicaid(spark, sf_dir) -> ncci.TableJobs:
    return ncci.medicaid_tables(*_inputs(spark, sf_dir, lambda h: L.medicaid_zips(h).select("url")))


_RELEASE_SQL = ", ".join(f"cast(regexp_extract(href, '{_FULL_RE}', {i}) as bigint)" for i in (1, 2, 3, 4))
_MEDICARE_SQL = f"""{FX_HREFS_SQL.rstrip()},
m as (
  select page_id, base_url, href_pos, href,
         [{_RELEASE_SQL}] as rel, cast(regexp_extract(href, '{_FULL_RE}', 5) as bigint) as part
  from fx_hrefs where regexp_matches(href, '{_FULL_RE}')),
newest as (select page_id, max(rel) as rel from m group by page_id),
full_parts as (
  select page_id, part as part_ord, {_resolve_sql('arg_min(href, href_pos)', 'arg_min(base_url, href_pos)')} as url
  from m join newest using (page_id, rel) group by page_id, part),
others as (
  select pages.page_id, min(href_pos) filter (where regexp_matches(href, '(?i){L.RE_DELTA_PRACTITIONER}')) as pos
  from pages left join fx_hrefs using (page_id) where pages.page_id not in (select page_id from newest) group by pages.page_id),
deltas as (select page_id, 0 as part_ord, {_join_sql('base_url', 'href')} as url from others join fx_hrefs using (page_id) where href_pos = pos),
chosen as (select * from full_parts union all select * from deltas),
kinds as (
  select page_id, 'full' as scope from newest
  union all select page_id, case when pos is null then 'none' else 'delta' end from others)"""

_MEDICAID_SQL = f"""{FX_HREFS_SQL.rstrip()},
m as (
  select page_id, href_pos, {_resolve_sql('href', 'base_url')} as url,
         coalesce(try_cast(nullif(regexp_extract(href, '(20\\d{{2}})', 1), '') as integer), 0) * 10
           + coalesce(try_cast(nullif(regexp_extract(href, '(?i)q([1-4])', 1), '') as integer), 0) as rel
  from fx_hrefs
  where lower(href) like '%medicaid%' and lower(href) like '%ptp%' and lower(href) like '%practitioner%' and lower(href) not like '%durable%' and lower(href) like '%.zip%'),
newest as (select page_id, max(rel) as rel from m group by page_id),
chosen as (select page_id, min(href_pos) as part_ord, url from m join newest using (page_id, rel) group by page_id, url),
kinds as (select page_id, case when page_id in (select page_id from newest) then 'medicaid_ptp' else 'none' end as scope from pages)"""

_FILES_SQL = f"""
files as (
  select *, sha256(url) as h, right(sha256(url), 1) not in ('0', '1') as readable, right(sha256(url), 1) <> '0' as fetched from chosen),
fx_ptp_rows as ({FX.FIXTURE_SQL['fx_ptp_rows']})
{_STAGED_SQL},
of_pages as (
  select page_id, part_ord, f.* from files join f
    on f.row_ord % {DEALT} = (strpos('0123456789abcdef', h[1]) - 1) * 16 + strpos('0123456789abcdef', h[2]) - 1
  where readable),
page_edits as (
  select * exclude (place) from (
    select *, row_number() over (partition by page_id, column1, column2, edit_kind order by part_ord, file_ord, row_ord) as place from of_pages)
  where place = 1),
counted as (select page_id, count(*) as n from page_edits group by page_id),
summed as (
  select page_id, count(*) as part_count, string_agg(url, ' ' order by part_ord) as source_zips,
         coalesce(string_agg(sha256(h), '' order by part_ord) filter (where fetched), '') as digests,
         string_agg(case when not fetched then 'SKIPPED{ncci.NOT_FETCHED}' || url when not readable then '{ncci.NOT_A_ZIP}' || url end, ' | ' order by part_ord) as warned
  from files group by page_id)"""

_RESULT_SQL = """
select kinds.page_id,
       case when scope = 'delta' and warned is not null then null else {doc} end as doc,
       case when scope = 'delta' and warned is not null then null else scope end as table_scope,
       case when scope = 'delta' and warned is not null then '' else coalesce(source_zips, '') end as source_zips,
       cast(case when scope = 'delta' and warned is not null then 0 else coalesce(part_count, 0) end as integer) as part_count,
       coalesce(n, 0) as edit_count_relevant,
       case when scope = 'none' or (scope = 'delta' and warned is not null) then '' when scope = 'delta' then digests else sha256(digests) end as content_sha256,
       case when scope = 'delta' and warned is not null then '{failed}' || replace(warned, 'SKIPPED', '{skipped}')
            else concat_ws(' | ', replace(warned, 'SKIPPED', '{skipped}'), {note}) end as warnings
from kinds left join summed using (page_id) left join counted using (page_id)"""


def _rendered(results: DataFrame) -> DataFrame:
    return results.withColumns({"source_zips": F.array_join("source_zips", " "), "warnings": F.array_join("warnings", " | ")})


@register(
    "ncci_table_results",
    covers=("E7", "L1", "L2", "S5", "S6"),
    oracle=_MEDICARE_SQL + "," + _FILES_SQL + _RESULT_SQL.format(
        doc=f"case scope when 'full' then '{X.DOC_LABELS['cms_ncci_edits']}' when 'delta' then '{X.NCCI_DELTA_DOC}' else '{X.NCCI_NO_LINK_DOC}' end",
        note=f"case scope when 'delta' then '{L.DELTA_WARNING}' when 'none' then '{L.NO_LINK_WARNING}' end", skipped="Skipped part", failed=MK.SCRAPE_FAILED,
    ),
)
def q_ncci_results(spark, sf_dir):
    return _rendered(_medicare(spark, sf_dir).results)


@register(
    "ncci_table_edits",
    covers=("E7", "P6"),
    oracle=_MEDICARE_SQL + "," + _FILES_SQL + "\nselect page_id, part_ord, file_ord, row_ord, column1, column2, modifier_indicator, edit_kind, source_file from page_edits",
)
def q_ncci_edits(spark, sf_dir):
    return _medicare(spark, sf_dir).edits


@register(
    "medicaid_table_results",
    covers=("E8", "L3", "S5"),
    oracle=_MEDICAID_SQL + "," + _FILES_SQL + _RESULT_SQL.format(
        doc=f"case scope when 'none' then '{X.MEDICAID_NO_LINK_DOC}' else '{X.DOC_LABELS['cms_ncci_medicaid']}' end",
        note=f"case scope when 'none' then '{ncci.NO_MEDICAID_WARNING}' end", skipped="Skipped zip", failed=MK.SCRAPE_FAILED,
    ),
)
def q_medicaid_results(spark, sf_dir):
    return _rendered(_medicaid(spark, sf_dir).results)


@register(
    "medicaid_table_edits",
    covers=("E8", "P6"),
    oracle=_MEDICAID_SQL + "," + _FILES_SQL + "\nselect page_id, cast(part_ord as bigint) as part_ord, file_ord, row_ord, column1, column2, modifier_indicator, edit_kind, source_file from page_edits",
)
def q_medicaid_edits(spark, sf_dir):
    return _medicaid(spark, sf_dir).edits
