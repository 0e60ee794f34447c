"""Extractor queries (X1-X12, E1-E5, E10-E13) over fx_source_text / fx_results.

Each query applies one extractor job to every document of the fixture, so the
work grows with the documents table. Lists are rendered with array_join in
the output so both engines hash the same text.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from regloom.operators import extract as X
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables


# ----------------------------------------------------------- SQL fragments
def _sd(t: str, pat: str, grp: int, flags: str = "") -> str:
    p = f"(?{flags}){pat}" if flags else pat
    return f"array_to_string(list_sort(list_distinct(regexp_extract_all({t}, '{p}', {grp}))), ',')"


def _first(t: str, pat: str, flags: str = "i") -> str:
    p = f"(?{flags}){pat}"
    return f"(case when regexp_matches({t}, '{p}') then regexp_extract({t}, '{p}', 1) end)"


def _word_or_int(tok: str) -> str:
    cases = " ".join(f"when '{w}' then {i}" for i, w in enumerate(X.NUMBER_WORDS, 1))
    return f"coalesce(cast((case lower({tok}) {cases} end) as bigint), try_cast({tok} as bigint))"


def _search(t: str, pat: str, flags: str = "i") -> str:
    return f"coalesce(regexp_matches({t}, '(?{flags}){pat}'), false)"


def _strip_template(t: str) -> str:
    return (
        f"regexp_replace(regexp_replace({t}, '(?i){X.RE_TEMPLATE_PLACEHOLDER}', '', 'g'), '^\\s+', '')"
    )


def _src(spark, sf_dir):
    return FX.fx_source_text(Tables(spark, sf_dir).documents).select("doc_id", "text")


def _joined(c, sep=","):
    return F.array_join(c, sep)


# --------------------------------------------------------------- queries
@register(
    "extract_cms_ch17",
    covers=("E1", "E2", "X1", "X1a", "X3", "X11"),
    oracle=FX.with_fixtures(
        f"""
select doc_id,
       {_word_or_int(_first('text', X.RE_IOP_G0137))} as iop_threshold_services,
       case when {_search('text', X.RE_IOP_G0137)} then 7 end as iop_window_days,
       {_sd('text', X.RE_G_CODE_CMS, 1)} as g_codes_mentioned,
       substring(text, 1, 2000) as raw_excerpt
from fx_source_text""",
        "fx_source_text",
    ),
)
def q_extract_cms_ch17(spark, sf_dir):
    out = X.extract_cms_ch17(_src(spark, sf_dir))
    return out.withColumn("g_codes_mentioned", _joined(F.col("g_codes_mentioned")))


@register(
    "extract_cms_ch39",
    covers=("E3", "X1a", "X2", "X11"),
    oracle=FX.with_fixtures(
        f"""
select doc_id,
       case when {_search('text', X.RE_WEEKLY_THRESHOLD)} then {_word_or_int(_first('text', X.RE_WEEKLY_THRESHOLD))}
            else 1 end as weekly_bundle_min_services,
       {_sd('text', X.RE_G_CODE_CMS, 1)} as g_codes_mentioned,
       substring(text, 1, 2000) as raw_excerpt
from fx_source_text""",
        "fx_source_text",
    ),
)
def q_extract_cms_ch39(spark, sf_dir):
    out = X.extract_cms_ch39(_src(spark, sf_dir))
    return out.withColumn("g_codes_mentioned", _joined(F.col("g_codes_mentioned")))


@register(
    "extract_mln_booklet",
    covers=("E4", "X4"),
    oracle=FX.with_fixtures(
        f"""
select doc_id, {_sd('text', X.RE_G_CODE_CMS, 1)} as g_codes_mentioned,
       {_search('text', X.RE_TAKEHOME)} as mentions_take_home,
       substring(text, 1, 2000) as raw_excerpt
from fx_source_text""",
        "fx_source_text",
    ),
)
def q_extract_mln(spark, sf_dir):
    out = X.extract_mln_booklet(_src(spark, sf_dir))
    return out.select(
        "doc_id",
        _joined(F.col("g_codes_mentioned")).alias("g_codes_mentioned"),
        "mentions_take_home",
        "raw_excerpt",
    )


@register(
    "extract_tip63",
    covers=("E10", "X10", "X11"),
    oracle=FX.with_fixtures(
        f"""
select doc_id,
       array_to_string(list_slice(regexp_extract_all(text, '(?i){X.RE_POLYSUBSTANCE}', 1), 1, 50), '|') as polysubstance_hits,
       cast(len(list_slice(regexp_extract_all(text, '(?i){X.RE_POLYSUBSTANCE}', 1), 1, 50)) as integer) as hit_count,
       substring(text, 1, 2000) as raw_excerpt, text as full_text
from fx_source_text""",
        "fx_source_text",
    ),
)
def q_extract_tip63(spark, sf_dir):
    out = X.extract_tip63(_src(spark, sf_dir), limit=X.POLYSUBSTANCE_LIMIT)
    return out.select(
        "doc_id",
        _joined(F.col("polysubstance_hits"), "|").alias("polysubstance_hits"),
        F.size("polysubstance_hits").alias("hit_count"),
        "raw_excerpt",
        "full_text",
    )


@register(
    "extract_cdc_zcodes",
    covers=("E11", "X1d"),
    oracle=FX.with_fixtures(
        f"""
select doc_id, {_sd('text', X.RE_SDOH_Z, 0)} as sdoh_z_codes_found,
       cast(len(list_distinct(regexp_extract_all(text, '{X.RE_SDOH_Z}', 0))) as integer) as z_code_count,
       substring(text, 1, 2000) as raw_excerpt
from fx_source_text""",
        "fx_source_text",
    ),
)
def q_extract_cdc(spark, sf_dir):
    out = X.extract_cdc_zcodes(_src(spark, sf_dir))
    return out.select(
        "doc_id",
        _joined(F.col("sdoh_z_codes_found")).alias("sdoh_z_codes_found"),
        "z_code_count",
        "raw_excerpt",
    )


@register(
    "extract_sunshine",
    covers=("E12", "X1b", "X1c", "X8", "X9"),
    oracle=FX.with_fixtures(
        f""",
s as (select doc_id, {_strip_template('text')} as t from fx_source_text)
select doc_id, {_sd('t', X.RE_F11, 0)} as f11_dx_codes_referenced,
       {_sd('t', X.RE_H_CODE, 1)} as h_codes_referenced,
       len(regexp_extract_all(t, '{X.RE_F11}', 0)) > 0 and len(regexp_extract_all(t, '{X.RE_H_CODE}', 1)) > 0
         as requires_dx_with_h_codes,
       substring(t, 1, 2000) as raw_excerpt
from s""",
        "fx_source_text",
    ),
)
def q_extract_sunshine(spark, sf_dir):
    out = X.extract_sunshine(_src(spark, sf_dir))
    return out.select(
        "doc_id",
        _joined(F.col("f11_dx_codes_referenced")).alias("f11_dx_codes_referenced"),
        _joined(F.col("h_codes_referenced")).alias("h_codes_referenced"),
        "requires_dx_with_h_codes",
        "raw_excerpt",
    )


@register(
    "extract_simply",
    covers=("E13", "X7", "X9"),
    oracle=FX.with_fixtures(
        f""",
s as (select doc_id, {_strip_template('text')} as t from fx_source_text),
m as (select doc_id, t, list_sort(list_distinct(list_transform(
          regexp_extract_all(t, '(?i){X.RE_COUNSELING_TIME}', 1), lambda x: try_cast(x as integer)))) as mins from s)
select doc_id, array_to_string(mins, ',') as counseling_time_thresholds_minutes,
       cast(list_min(mins) as integer) as min_counseling_threshold_minutes,
       substring(t, 1, 2000) as raw_excerpt, t as full_text
from m""",
        "fx_source_text",
    ),
)
def q_extract_simply(spark, sf_dir):
    out = X.extract_simply(_src(spark, sf_dir))
    return out.select(
        "doc_id",
        F.array_join(F.transform("counseling_time_thresholds_minutes", lambda x: x.cast("string")), ",").alias(
            "counseling_time_thresholds_minutes"
        ),
        "min_counseling_threshold_minutes",
        "raw_excerpt",
        "full_text",
    )


@register(
    "extract_handbook_rollup",
    covers=("E5", "X5", "X6", "X1b"),
    oracle=FX.with_fixtures(
        f""",
h as (select source_key,
             {_search('text', X.RE_HF)} as hf,
             {_search('text', X.RE_POS_58)} as pos,
             {_search('text', X.RE_HD_HG, 'is')} as hdhg,
             {_sd('text', X.RE_H_CODE, 1)} as hc
      from fx_source_text)
select source_key, count(*) as handbook_count,
       coalesce(bool_or(hf), false) as any_HF_mentioned,
       coalesce(bool_or(pos), false) as any_POS_58_mentioned,
       coalesce(bool_or(hdhg), false) as any_HD_HG_pair_mentioned,
       cast(count_if(hc <> '') as bigint) as handbooks_with_h_codes
from h group by source_key""",
        "fx_source_text",
    ),
)
def q_extract_handbooks(spark, sf_dir):
    docs = FX.fx_source_text(Tables(spark, sf_dir).documents).select("source_key", "text")
    hb = X.handbook_facts(docs)
    return X.handbook_rollup(
        hb, extra=[F.count_if(F.size("h_codes_referenced") > 0).alias("handbooks_with_h_codes")]
    )


@register(
    "extract_facts_dispatch",
    covers=("E1", "E2", "E3", "E4", "S3"),
    oracle=FX.with_fixtures(
        f"""
select result_ord, source_key,
       case when source_key = 'cms_pub_100_04_ch39' then
            case when {_search('text', X.RE_WEEKLY_THRESHOLD)} then {_word_or_int(_first('text', X.RE_WEEKLY_THRESHOLD))} else 1 end
       end as weekly_bundle_min_services,
       case when source_key = 'cms_pub_100_02_ch17' then {_word_or_int(_first('text', X.RE_IOP_G0137))} end as iop_threshold_services,
       case when source_key = 'cms_pub_100_02_ch17' and {_search('text', X.RE_IOP_G0137)} then 7 end as iop_window_days,
       case when source_key in ('cms_pub_100_02_ch17', 'cms_pub_100_04_ch39', 'cms_mln_otp_booklet')
            then {_sd('text', X.RE_G_CODE_CMS, 1)} end as g_codes_mentioned,
       case when source_key = 'cms_mln_otp_booklet' then {_search('text', X.RE_TAKEHOME)} end as mentions_take_home,
       case when source_key in ('cms_pub_100_02_ch17', 'cms_pub_100_04_ch39', 'cms_mln_otp_booklet')
            then substring(text, 1, 2000) end as raw_excerpt
from fx_results""",
        "fx_results",
    ),
)
def q_extract_dispatch(spark, sf_dir):
    res = FX.fx_results(Tables(spark, sf_dir).documents).select("result_ord", "source_key", "text")
    f = X.extract_facts(res)
    return f.select(
        "result_ord",
        "source_key",
        "weekly_bundle_min_services",
        "iop_threshold_services",
        "iop_window_days",
        _joined(F.col("g_codes_mentioned")).alias("g_codes_mentioned"),
        "mentions_take_home",
        "raw_excerpt",
    )
