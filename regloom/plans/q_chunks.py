"""Chunking queries (C1-C8) over documents and fixture views."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import chunks as C
from regloom.plans.registry import register
from regloom.sources import catalog as S
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

# Shared oracle fragments (DuckDB SQL). RE2 classes are ASCII; the inputs'
# whitespace is ASCII, so they agree with the (?U) Java patterns here.
_WINDOWS_SQL = """
select u.*, w.window_ord,
       substring(u.text, w.window_ord * 1050 + 1, 1200) as piece
from {units} u,
     lateral (select unnest(range(0, cast(greatest(0, ceil((length(u.text) - 1200) / 1050.0)) as bigint) + 1)) as window_ord) w
"""


def _chunk_cols_sql(extra: str) -> str:
    return f"""
select {extra}, cast(window_ord as integer) as window_ord,
       substring(sha256(source_key || '|' || label || '|' || piece), 1, 16) as chunk_id,
       source_key, label, piece as text, cast(length(piece) as integer) as char_count
from windows"""


def document_units(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.col("source").alias("source_key"), F.col("lang").alias("label"), "text")


def unit_chunks(units: DataFrame) -> DataFrame:
    return C.explode_windows(units).select("doc_id", "window_ord", *C.CHUNK_COLUMNS)


def documents_chunks(documents: DataFrame) -> DataFrame:
    return unit_chunks(document_units(documents))


@register(
    "chunk_windows",
    covers=("C2", "C3"),
    oracle=f"""
with units as (select doc_id, source as source_key, lang as label, coalesce(text, '') as text from documents),
windows as ({_WINDOWS_SQL.format(units='units')})
{_chunk_cols_sql('doc_id')}
""",
)
def q_chunk_windows(spark, sf_dir):
    return documents_chunks(Tables(spark, sf_dir).documents)


_PARA_UNITS_SQL = r"""
paras as (
  select doc_id, source_key, label,
         list_filter(list_transform(
             string_split_regex(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '\n\s*\n'),
             lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ps
  from fx_source_text),
units as (
  select doc_id, source_key, label,
         cast(generate_subscripts(ps, 1) - 1 as integer) as unit_ord, unnest(ps) as text
  from paras)
"""


@register(
    "chunk_paragraphs",
    covers=("C1", "C2", "C3", "C6"),
    oracle=FX.with_fixtures(
        f""",
{_PARA_UNITS_SQL},
windows as ({_WINDOWS_SQL.format(units='units')})
{_chunk_cols_sql('doc_id, unit_ord')}
""",
        "fx_source_text",
    ),
)
def q_chunk_paragraphs(spark, sf_dir):
    src = FX.fx_source_text(Tables(spark, sf_dir).documents)
    units = C.paragraph_units(src)
    return C.explode_windows(units).select("doc_id", "unit_ord", "window_ord", *C.CHUNK_COLUMNS)


def sectioned_results(documents: DataFrame) -> DataFrame:
    """Scrape-result rows for the chunk router, derived from documents.

    Every third document carries sections (one per text line; the id is left
    out on every ninth document to exercise the '?' label); the others carry
    their text, where doc_id % 4 == 1 as the raw form (whole, no full_text).
    """
    d = F.col("doc_id")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    sections = F.transform(
        lines,
        lambda x, i: F.struct(
            F.when(d % 9 != 0, F.concat(F.lit("S"), d.cast("string"), F.lit("."), i.cast("string"))).alias("id"),
            F.substring(x, 1, 40).alias("label"),
            x.alias("text"),
        ),
    )
    has = d % 3 == 0
    return documents.select(
        d.alias("result_ord"),
        F.col("source").alias("source_key"),
        F.concat(F.lit("name-"), F.col("source")).alias("source_name"),
        F.when(has, sections).alias("sections"),
        F.when(~has & (d % 4 != 1), F.col("text")).otherwise(F.lit("")).alias("full_text"),
        F.when(~has, F.col("text")).alias("raw_excerpt"),
    )


@register(
    "chunk_routes",
    covers=("C1", "C2", "C3", "C4", "C5", "C6"),
    oracle=r"""
with sec_src as (
  select doc_id, source, string_split(coalesce(text, ''), chr(10)) as ls from documents where doc_id % 3 = 0),
sec_units as (
  select doc_id as result_ord, source as source_key,
         cast(generate_subscripts(ls, 1) - 1 as integer) as unit_ord, unnest(ls) as line, doc_id as d
  from sec_src),
sec as (
  select result_ord, source_key, unit_ord,
         coalesce(case when d % 9 <> 0 then 'S' || cast(d as varchar) || '.' || cast(unit_ord as varchar) end, '?')
           || ' ' || coalesce(substring(line, 1, 40), '') as label,
         coalesce(line, '') as text
  from sec_units),
free_src as (
  select doc_id as result_ord, source as source_key, 'name-' || source as label,
         coalesce(text, '') as body
  from documents where doc_id % 3 <> 0),
free_paras as (
  select result_ord, source_key, label,
         list_filter(list_transform(
             string_split_regex(regexp_replace(body, '^\s+|\s+$', '', 'g'), '\n\s*\n'),
             lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ps
  from free_src),
free as (
  select result_ord, source_key, cast(generate_subscripts(ps, 1) - 1 as integer) as unit_ord, label, unnest(ps) as text
  from free_paras),
units as (select * from sec union all select * from free),
windows as (""" + _WINDOWS_SQL.format(units="units") + ")" + _chunk_cols_sql("result_ord, unit_ord"),
)
def q_chunk_routes(spark, sf_dir):
    res = sectioned_results(Tables(spark, sf_dir).documents)
    return C.chunk_for_rag(res)


@register(
    "chunk_engine2_routing",
    covers=("C7", "S1"),
    oracle=FX.with_fixtures(
        f""",
units as (
  select result_ord, source_key, source_key as label, text from fx_results
  where source_key in ({S.ENGINE2_KEYS_SQL})),
windows as ({_WINDOWS_SQL.format(units='units')})
{_chunk_cols_sql('result_ord')}
""",
        "fx_results",
    ),
)
def q_chunk_engine2(spark, sf_dir):
    return C.explode_windows(engine2_units(spark, sf_dir)).select("result_ord", "window_ord", *C.CHUNK_COLUMNS)


def engine2_units(spark, sf_dir) -> DataFrame:
    routed = C.route_engine2(FX.fx_results(Tables(spark, sf_dir).documents), S.catalog_df(spark))
    return routed.select("result_ord", "source_key", F.col("source_key").alias("label"), "text")


@register(
    "chunk_new_only",
    covers=("C8",),
    oracle=FX.with_fixtures(
        f""",
old_units as (select doc_id, source as source_key, lang as label, coalesce(text, '') as text from documents),
new_units as (select doc_id, source_key, label, coalesce(text, '') as text from fx_source_text),
old_w as ({_WINDOWS_SQL.format(units='old_units')}),
new_w as ({_WINDOWS_SQL.format(units='new_units')}),
old_ids as (select distinct substring(sha256(source_key || '|' || label || '|' || piece), 1, 16) as chunk_id from old_w),
new_ids as (select doc_id, cast(window_ord as integer) as window_ord,
                   substring(sha256(source_key || '|' || label || '|' || piece), 1, 16) as chunk_id,
                   cast(length(piece) as integer) as char_count from new_w)
select * from new_ids where chunk_id not in (select chunk_id from old_ids)
""",
        "fx_source_text",
    ),
)
def q_chunk_new_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    known = documents_chunks(t.documents).select("chunk_id")
    fresh = C.explode_windows(FX.fx_source_text(t.documents)).select("doc_id", "window_ord", "chunk_id", "char_count")
    return C.new_chunks(fresh, known)
