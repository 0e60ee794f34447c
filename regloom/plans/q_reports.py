"""Report queries (R1-R9) over fixture results, rules, chunks and diffs."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import chunks as C
from regloom.operators import extract as X
from regloom.operators import matrix as M
from regloom.operators import report as RP
from regloom.plans.q_chunks import document_units, documents_chunks, engine2_units, unit_chunks
from regloom.plans.q_diff import fixture_changes
from regloom.plans.q_matrix import matrix_results
from regloom.plans.registry import _REGISTRY, register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

CH39, CH17, MLN, FCSO, ECFR = (
    "cms_pub_100_04_ch39", "cms_pub_100_02_ch17", "cms_mln_otp_booklet", "fl_mac_fcso_otp", "ecfr_42_part_8"
)


def report_results(documents: DataFrame) -> DataFrame:
    """Results with the facts the run summary reads (present only when the
    result parsed: a failed or empty result has no facts)."""
    res = matrix_results(documents, keep_text=True)
    d, k, t = F.col("result_ord"), F.col("source_key"), F.col("text")
    parsed = ~RP.failed(F.col("warnings")) & ~F.col("parsed_empty")
    return res.select(
        "result_ord", "source_key", "source_name", "fetched_at", "content_sha256", "warnings",
        F.when(parsed & (k == ECFR), F.size(F.split(F.coalesce(t, F.lit("")), "\n"))).alias("section_count"),
        F.when(parsed & (d % 9 != 4), F.col("g_codes_mentioned")).alias("g_codes_mentioned"),
        F.when(parsed & (d % 11 == 6), d % 5).alias("edit_count_relevant"),
        F.when(parsed & (d % 3 == 1), F.split(F.substring(t, 1, 60), " ")).alias("candidate_links"),
        F.when(parsed, X.doc_label(k)).otherwise(F.lit("")).alias("doc_label"),
    )


def landed_files(documents: DataFrame) -> DataFrame:
    fx = FX.fx_results(documents)
    return fx.select("source_key", F.octet_length("text").cast("bigint").alias("length"))


_SUMMARY_SQL = f"""
with r as (
  select doc_id as result_ord,
         case doc_id % 5 when 0 then '{CH39}' when 1 then '{CH17}' when 2 then '{FCSO}' when 3 then '{ECFR}' else '{MLN}' end as source_key,
         doc_id % 17 = 0 as failed, doc_id % 23 = 0 as parsed_empty, text
  from documents),
f as (select source_key, sum(octet_length(encode(text))) as raw_bytes from r group by source_key),
s as (
  select r.*, not failed and not parsed_empty as parsed,
         case when source_key = '{ECFR}' then cast(len(string_split(coalesce(text, ''), chr(10))) as bigint) end as sc,
         case when source_key in ('{CH39}', '{CH17}', '{MLN}') then cast(len(list_distinct(regexp_extract_all(text, '{X.RE_G_CODE_CMS}', 1))) as bigint)
              when source_key = '{FCSO}' then cast(len(list_distinct(regexp_extract_all(text, '{X.RE_G_CODE_ANY}', 1))) as bigint) end as gc0,
         case when result_ord % 9 <> 4 then gc0 end as gc,
         case when result_ord % 11 = 6 then result_ord % 5 end as ec,
         case when result_ord % 3 = 1 then cast(len(string_split(substring(text, 1, 60), ' ')) as bigint) end as cl
  from r)
select result_ord, source_key, case when failed then 'FAIL' else 'OK' end as status,
       cast(case when not parsed then 0 when sc is not null then sc when ec is not null then ec when gc is not null then gc when cl is not null then cl else 0 end as bigint) as extracted_count,
       case when not parsed then '' when sc is not null then 'sections' when ec is not null then 'NCCI edits' when gc is not null then 'G-codes mentioned'
            when cl is not null then 'PDF links' else '' end as extracted_unit,
       case when failed then 'scrape_failed: 503' else '' end as warnings_text,
       cast(coalesce(f.raw_bytes, 0) as bigint) as raw_bytes,
       case when not parsed then ''
            when source_key = '{CH39}' then '{X.DOC_LABELS[CH39]}' when source_key = '{CH17}' then '{X.DOC_LABELS[CH17]}'
            when source_key = '{MLN}' then '{X.DOC_LABELS[MLN]}' when source_key = '{FCSO}' then '{X.DOC_LABELS[FCSO]}'
            else '{X.DOC_LABELS[ECFR]}' end as doc_label,
       source_key || '.json' as file_name
from s left join f using (source_key)
"""


@register("run_summary", covers=("R1", "R2", "R3", "S6"), oracle=_SUMMARY_SQL)
def q_run_summary(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    res = report_results(docs)
    parsed_cols = {c: F.col(c) for c in ("section_count", "edit_count_relevant", "g_codes_mentioned", "candidate_links")}
    out = RP.run_summary(res, landed_files(docs), parsed_cols)
    return out.select(
        "result_ord", "source_key", "status", "extracted_count", "extracted_unit", "warnings_text", "raw_bytes",
        "doc_label", "file_name",
    )


def _sub(name: str) -> str:
    """Another query's oracle as a subquery (its module registered it already)."""
    return f"({_REGISTRY[name].oracle.strip()})"


@register(
    "rules_flat",
    covers=("R4",),
    oracle=f"""
select rule_ord, rule_id, payer_type, code, coalesce(required_modifier, '') as required_modifier, logic_type,
       source_key, coalesce(friendly_message, '') as friendly_message,
       coalesce(regexp_replace(regexp_replace(params_json, ',(\\S)', ', \\1', 'g'), '":', '": ', 'g'), '{{}}') as params_json
from {_sub('rule_matrix')} m""",
)
def q_rules_flat(spark, sf_dir):
    return RP.rules_flat(M.build_rules(matrix_results(Tables(spark, sf_dir).documents)))


@register(
    "chunk_report",
    covers=("R5",),
    oracle=f"""
select doc_id, window_ord, chunk_id, source_key, label, char_count,
       replace(substring(text, 1, 200), chr(10), ' ') as preview
from {_sub('chunk_windows')} c""",
)
def q_chunk_report(spark, sf_dir):
    return RP.chunk_table(documents_chunks(Tables(spark, sf_dir).documents))


@register(
    "chunks_per_source",
    covers=("R7",),
    oracle=f"select source_key, count(*) as chunk_count from {_sub('chunk_windows')} c group by source_key",
)
def q_chunks_per_source(spark, sf_dir):
    units = document_units(Tables(spark, sf_dir).documents)
    return RP.chunks_per_source(units.select("source_key", C.chunk_counts(F.length("text")).alias("chunk_count")))


@register(
    "chunk_samples",
    covers=("R8",),
    oracle=f"""
select doc_id, window_ord, source_key, label, char_count,
       substring(text, 1, 400) || case when length(text) > 400 then '…' else '' end as sample
from {_sub('chunk_windows')} c order by doc_id, window_ord limit 3""",
)
def q_chunk_samples(spark, sf_dir):
    return RP.first_chunk_samples(document_units(Tables(spark, sf_dir).documents), ["doc_id"], unit_chunks, ["window_ord"])


@register(
    "run_totals",
    covers=("R6",),
    oracle=f"""
select (select count(*) from documents where doc_id % 17 <> 0) as ok,
       (select count(*) from documents where doc_id % 17 = 0) as fail,
       (select count(*) from {_sub('rule_matrix')} m) as rule_count,
       (select count(*) from {_sub('chunk_engine2_routing')} c) as chunk_count""",
)
def q_run_totals(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    res = matrix_results(docs)
    rules = M.build_rules(res, numbered=False)
    chunks = engine2_units(spark, sf_dir).select(C.chunk_counts(F.length("text")).alias("chunk_count"))
    return RP.totals(res, rules, chunks)


@register(
    "diff_overview",
    covers=("R9",),
    oracle=f"""
select s.added_count, s.removed_count, s.changed_count,
       coalesce((select string_agg(rule_id, ',' order by rule_id) from
                   (select rule_id from {_sub('diff_added_removed')} a where change_type = 'rule_added'
                    order by rule_id limit 5) t), '') as first_added
from {_sub('diff_summary')} s""",
)
def q_diff_overview(spark, sf_dir):
    return RP.diff_overview(fixture_changes(spark, sf_dir))


_ONLY = ["cms_pub_100_04_ch39", "ecfr_42_part_8", "fl_mac_fcso_otp", "not_a_source"]


@register(
    "source_selection",
    covers=("S1", "S2", "S3"),
    oracle=FX.with_fixtures(
        f"""
select source_key, count(*) as result_count from fx_results
where source_key in ('cms_pub_100_04_ch39', 'ecfr_42_part_8', 'fl_mac_fcso_otp')
group by source_key""",
        "fx_results",
    ),
)
def q_source_selection(spark, sf_dir):
    """Results of a run restricted to ``only`` (unknown keys ignored), registered
    sources only, counted per source."""
    from regloom.sources import catalog as S

    cat = S.registered(S.select_sources(S.catalog_df(spark), _ONLY), spark).select(F.col("key").alias("source_key"))
    res = FX.fx_results(Tables(spark, sf_dir).documents)
    return res.join(F.broadcast(cat), "source_key", "left_semi").groupBy("source_key").agg(F.count(F.lit(1)).alias("result_count"))


def _catalog_values() -> str:
    from regloom.sources.catalog import SOURCES

    text = lambda v: "'" + v.replace("'", "''") + "'"
    return ",\n  ".join("(" + ", ".join(map(text, row)) + ")" for row in SOURCES)


@register(
    "source_lookup",
    covers=("S1",),
    oracle=FX.with_fixtures(
        f""",
catalog(source_key, source_name, url, cadence, engine, fetch_mode) as (values
  {_catalog_values()})
select result_ord, source_key, source_name, url, cadence, engine, fetch_mode from fx_results join catalog using (source_key)""",
        "fx_results",
    ),
)
def q_source_lookup(spark, sf_dir):
    """Every result with its source's catalog entry."""
    from regloom.sources import catalog as S

    res = FX.fx_results(Tables(spark, sf_dir).documents).select("result_ord", "source_key")
    found = S.by_key(S.catalog_df(spark), res)
    return found.select("result_ord", "source_key", F.col("name").alias("source_name"), "url", "cadence", "engine", "fetch_mode")
