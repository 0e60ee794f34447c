"""Composed handbook results (E5): every page as a landing page, documents as its handbooks."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import extract as X
from regloom.operators import handbooks as H
from regloom.operators import markup as MK
from regloom.plans.q_extract import _sd, _search
from regloom.plans.q_markup import FX_PAGES_SQL, _strip_sql, _url_join_sql, fx_pages
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

FILES = "https://files.example.org/content/download/"


def fx_handbook_pages(pages: DataFrame) -> DataFrame:
    """Pages whose articles end in links to handbooks: two files, the first again, a known one, a player. Some pages are missing."""
    p = F.col("page_id")
    link = lambda doc, label: F.concat(F.lit(f'<a href="{FILES}'), doc.cast("string"), F.lit(f'/file/handbook.pdf">{label}</a>'))
    planted = F.concat(
        F.lit("<p>"), link(p * 4, "Policy"), link(p * 2 + 1, "Rule"), link(p * 4, "Policy again"),
        F.lit(f'<a href="{MK.KNOWN_HANDBOOK_PDFS[1][1]}">other name</a>'), link(p * 3, "Get Windows Media Player"), F.lit("</p></article>"),
    )
    return fx_pages(pages).select("page_id", "url", F.when(p % 50 != 7, F.replace("html", F.lit("</article>"), planted)).alias("html"))


def fx_handbook_files(documents: DataFrame) -> DataFrame:
    """Documents as fetched files: eight of them are the known handbooks; every thirteenth failed."""
    d = F.col("doc_id")
    known = F.array(*[F.lit(u) for _, u in MK.KNOWN_HANDBOOK_PDFS])
    url = F.when((d % 8 == 0) & (d < 64), F.get(known, (d / 8).cast("int"))).otherwise(F.concat(F.lit(FILES), d.cast("string"), F.lit("/file/handbook.pdf")))
    fetched = d % 13 != 5
    return FX.fx_source_text(documents).select(url.alias("url"), F.when(fetched, F.col("text")).alias("text"), F.when(~fetched, F.lit("HTTP 404")).alias("error"))


def _link_sql(doc: str, label: str) -> str:
    return f"""'<a href="{FILES}' || cast({doc} as varchar) || '/file/handbook.pdf">{label}</a>'"""


_KNOWN_ROWS = ", ".join(f"({i}, '{n}', '{u}')" for i, (n, u) in enumerate(MK.KNOWN_HANDBOOK_PDFS))
_HANDBOOKS_SQL = (
    FX_PAGES_SQL.rstrip()
    + f""",
hb_pages as (
  select page_id, url, case when page_id % 50 <> 7 then replace(html, '</article>', '<p>' || {_link_sql('page_id * 4', 'Policy')}
    || {_link_sql('page_id * 2 + 1', 'Rule')} || {_link_sql('page_id * 4', 'Policy again')}
    || '<a href="{MK.KNOWN_HANDBOOK_PDFS[1][1]}">other name</a>' || {_link_sql('page_id * 3', 'Get Windows Media Player')} || '</p></article>') end as html
  from fx_pages),
known as (select * from (values {_KNOWN_ROWS}) as k(ord, label, url)),
anchors as (
  select page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) as hs,
         regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) as ls
  from hb_pages where html is not null),
links as (select page_id, url, 8 + generate_subscripts(hs, 1) as ord, unnest(hs) as href, unnest(ls) as inner_html from anchors),
labelled as (
  select page_id, ord, {_url_join_sql('url', 'href')} as url,
         substring(array_to_string(list_filter(list_transform(regexp_split_to_array(inner_html, '<[^>]*>'), lambda x: {_strip_sql('x')}), lambda x: x <> ''), ''), 1, 200) as label
  from links where lower(href) like '%.pdf' or href like '%/content/download/%'),
listing as (
  select page_id, ord, label, url from labelled where lower(label) not like '%windows%' and lower(label) not like '%media%'
  union all select page_id, ord, label, known.url from hb_pages cross join known),
firsts as (select *, row_number() over (partition by page_id, url order by ord) as rn from listing),
fx_source_text as ({FX.FIXTURE_SQL['fx_source_text']}),
files as (
  select case when doc_id % 8 = 0 and doc_id < 64 then (select url from known where ord = doc_id / 8) else '{FILES}' || cast(doc_id as varchar) || '/file/handbook.pdf' end as url,
         case when doc_id % 13 <> 5 then text end as text, case when doc_id % 13 = 5 then 'HTTP 404' end as error
  from fx_source_text),
met as (
  select page_id, ord, label, firsts.url, text, coalesce(error, 'not landed') as error,
         {_search('text', X.RE_HF)} as hf, {_search('text', X.RE_POS_58)} as pos, {_search('text', X.RE_HD_HG, 'is')} as hdhg, {_sd('text', X.RE_H_CODE, 1)} as codes
  from firsts left join files on files.url = firsts.url where rn = 1),
per_page as (
  select page_id, count(text) as handbook_count,
         coalesce(string_agg(label, chr(31) order by ord) filter (text is not null), '') as labels,
         coalesce(string_agg(url, chr(31) order by ord) filter (text is not null), '') as urls,
         coalesce(string_agg(cast(length(text) as varchar), ',' order by ord) filter (text is not null), '') as char_counts,
         coalesce(string_agg(codes, ';' order by ord) filter (text is not null), '') as h_codes,
         coalesce(string_agg(substring(text, 1, 1500), chr(31) order by ord) filter (text is not null), '') as excerpts,
         coalesce(string_agg(text, chr(31) order by ord) filter (text is not null), '') as full_texts,
         coalesce(bool_or(hf), false) as any_HF_mentioned, coalesce(bool_or(pos), false) as any_POS_58_mentioned, coalesce(bool_or(hdhg), false) as any_HD_HG_pair_mentioned,
         coalesce(string_agg('{H.FILE_WARNING}' || url || ': ' || error, ' | ' order by ord) filter (text is null), '') as file_warnings
  from met group by page_id)
select page_id, '{X.DOC_LABELS[H.SOURCE_KEY]}' as doc, handbook_count, labels, urls, char_counts, h_codes, excerpts, full_texts,
       any_HF_mentioned, any_POS_58_mentioned, any_HD_HG_pair_mentioned,
       concat_ws(' | ', case when html is null then '{H.LANDING_WARNING}{MK.NO_PAGE}' end, nullif(file_warnings, '')) as warnings
from per_page join hb_pages using (page_id)"""
)


@register("handbook_results", covers=("E5", "X5", "X6", "X16"), oracle=_HANDBOOKS_SQL)
def q_handbook_results(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pages = fx_handbook_pages(t.pages)
    out = H.handbook_results(MK.parse_pages(pages), fx_handbook_files(t.documents))
    of = lambda f: F.transform("handbooks", f)
    return out.select(
        "page_id", "doc", "handbook_count",
        F.array_join(of(lambda h: h["label"]), "\x1f").alias("labels"),
        F.array_join(of(lambda h: h["url"]), "\x1f").alias("urls"),
        F.array_join(of(lambda h: h["char_count"].cast("string")), ",").alias("char_counts"),
        F.array_join(of(lambda h: F.array_join(h["h_codes_referenced"], ",")), ";").alias("h_codes"),
        F.array_join(of(lambda h: h["excerpt"]), "\x1f").alias("excerpts"),
        F.array_join(of(lambda h: h["full_text"]), "\x1f").alias("full_texts"),
        "any_HF_mentioned", "any_POS_58_mentioned", "any_HD_HG_pair_mentioned",
        F.array_join("warnings", " | ").alias("warnings"),
    )
