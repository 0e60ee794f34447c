"""Rule-matrix queries (M1-M20) over fx_results and fx_ptp_rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import extract as X
from regloom.operators import matrix as M
from regloom.operators import ptp as P
from regloom.operators.coverage import coverage_report
from regloom.operators.templates import FACT_TYPES, RULE_SCHEMA_VERSION
from regloom.plans.q_ptp import _STAGED_SQL, raw_rows
from regloom.plans.q_extract import _first, _search, _word_or_int
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

CH39, CH17, FCSO = "cms_pub_100_04_ch39", "cms_pub_100_02_ch17", "fl_mac_fcso_otp"


def matrix_results(documents: DataFrame, keep_text: bool = False) -> DataFrame:
    """Scrape results with typed facts, derived from fx_results."""
    fx = FX.fx_results(documents).withColumnRenamed("iop_threshold_services", "_iop").withColumn("_body", F.col("text"))
    fx = X.extract_facts(fx, "_body", every_source=True)
    t = F.col("text")
    return fx.select(
        *(["text"] if keep_text else []),
        "result_ord",
        "source_key",
        F.col("source_key").alias("source_name"),
        F.lit("2026-05-22T00:00:00Z").alias("fetched_at"),
        F.sha2(t, 256).alias("content_sha256"),
        F.when(F.col("warning") != "", F.array("warning")).otherwise(F.array().cast("array<string>")).alias("warnings"),
        F.col("parsed_is_empty").alias("parsed_empty"),
        F.col("weekly_bundle_min_services"),
        F.col("g_codes_mentioned"),
        F.col("_iop").cast("bigint").alias("iop_threshold_services"),
        F.when(F.col("_iop").isNotNull(), F.lit(7)).alias("iop_window_days"),
    )


_DUCK_TYPES = {"bigint": "bigint", "int": "integer", "boolean": "boolean", "array<string>": "varchar[]"}
_GIVEN = {
    "weekly_bundle_min_services": f"case when source_key = '{CH39}' then "
    f"(case when {_search('text', X.RE_WEEKLY_THRESHOLD)} then {_word_or_int(_first('text', X.RE_WEEKLY_THRESHOLD))} else 1 end) end",
    "g_codes_mentioned": f"case when source_key = '{CH39}' then list_sort(list_distinct(regexp_extract_all(text, '{X.RE_G_CODE_CMS}', 1))) "
    f"when source_key = '{FCSO}' then list_sort(list_distinct(regexp_extract_all(text, '{X.RE_G_CODE_ANY}', 1))) end",
    "iop_threshold_services": "iop_threshold_services",
    "iop_window_days": "case when iop_threshold_services is not null then 7 end",
}
_FACTS_SQL = (
    """,
facts as (
  select result_ord, source_key, warning like '%scrape_failed%' as failed, parsed_is_empty as parsed_empty,
         sha256(text) as content_sha256, '2026-05-22T00:00:00Z' as fetched_at, """
    + ",\n         ".join(
        f"cast({_GIVEN.get(c, 'null')} as {_DUCK_TYPES[t]}) as {c}" for c, t in FACT_TYPES.items()
    )
    + """
  from fx_results)"""
)


@register(
    "rule_matrix",
    covers=("M1", "M2", "M3", "M4", "M6", "M7", "M8", "M10", "M12"),
    oracle=FX.with_fixtures(
        _FACTS_SQL
        + f""",
rules as ({M.duck_template_sql('facts')})
select row_number() over (order by case when source_key in ({M.federal_sql_list()}) then 0 else 1 end,
                                   result_ord, template_ord, edit_ord) - 1 as rule_ord,
       rule_id, payer_type, code, required_modifier, logic_type, source_key, friendly_message, params_json
from rules""",
        "fx_results",
    ),
)
def q_rule_matrix(spark, sf_dir):
    return M.build_rules(matrix_results(Tables(spark, sf_dir).documents), max_h_codes=25)  # as in the SQL


#: Every source with rules, the deferred ones (11, 12), one of each kind without rules.
ALL_SOURCES = [
    CH39, CH17, "cms_mln_otp_booklet", "fl_ahca_cbh_handbook", "ecfr_42_part_8", FCSO, "sunshine_provider_manual", "simply_provider_resources", "fl_dcf_fasams",
    "fl_mso_contracts", "fl_eforcse_pdmp", "internal_policy", "fl_ahca_carf_ai_consent", "fl_65d30_fac", "samhsa_tip_63", "not_in_the_catalog",
]


def source_results(documents: DataFrame) -> DataFrame:
    """Every document as a result of one of ALL_SOURCES in turn, with the facts of its text; every 19th failed."""
    d = F.col("doc_id")
    key = F.element_at(F.array(*[F.lit(k) for k in ALL_SOURCES]), (d % len(ALL_SOURCES) + 1).cast("int"))
    src = FX.fx_source_text(documents).select(d.alias("result_ord"), key.alias("source_key"), "text")
    # Sunshine and Simply texts take turns in what they say: the kinds of fx_source_text go by the document's number.
    said = F.when(F.col("result_ord") % 3 == 0, F.lit(" H0020 and H0001 with F11.20; 25 min session.")).when(F.col("result_ord") % 3 == 1, F.lit(" H2010 only.")).otherwise(F.lit(" G0137 requires a minimum of twelve services."))
    facts = X.extract_facts(src.withColumn("text", F.concat("text", said)), every_source=True)
    return facts.withColumns({
        "source_name": F.col("source_key"), "fetched_at": F.lit(""), "content_sha256": F.lit(""), "parsed_empty": F.lit(False),
        "warnings": F.when(F.col("result_ord") % 19 == 5, F.array(F.lit("scrape_failed: 503"))).otherwise(F.array().cast("array<string>")),
    })


_CODES = lambda c: f"'[' || coalesce(array_to_string(list_transform({c}, lambda x: '\"' || x || '\"'), ','), '') || ']'"
# Rules as the sources' texts ask for them: (place of the source, order, id, payer, code, modifier, logic, params, numbers of the message, condition).
# Fixed values, written out by hand.
_SOURCE_RULES = [
    (0, 0, "R-FED-01", "Medicare Advantage", "G2067", None, "BundleValidation", f"""'{{"min_services_in_bundle":' || weekly || ',"window_days":7,"g_codes_in_scope":' || {_CODES('g_cms')} || '}}'""", "'2067,2079,' || weekly || ',7,100,04,39'", "true"),
    (1, 0, "R-FED-02", "Medicare", "G0137", None, "IopThresholdGuard", """'{"required_services":' || iop || ',"window_days":7}'""", "'0137,' || iop || ',7,100,02,17'", "coalesce(iop, 0) <> 0"),
    (3, 0, "R-FL-02", "Managed Medicaid", "H0020", "POS-58", "PointOfCareBlock", "null", "'0020,58'", "true"),
    (3, 1, "R-FL-03", "AHCA Medicaid", "ALL_SUD", "HF", "SubstanceAbuseModifier", "null", "''", "true"),
    (3, 2, "R-FL-04", "AHCA Medicaid", "H0020", "HD>HG", "ModifierSequencer", """'{"trigger_icd_prefix":"O","alt_modifier":"HG"}'""", "'0020,10'", "true"),
    (3, 3, "R-FL-05", "AHCA Medicaid", "H0020", None, "DosingCounselingRatio", """'{"min_counseling_sessions":1,"window_days":30,"regulatory_basis":"FL AHCA Community Behavioral Health Services Handbook","maturity":"evolving","matrix_rule_number":4}'""", "'0020,1,30'", "true"),
    (4, 0, "R-FED-03", "Federal SAMHSA", "ADMISSION", None, "AdmissionEligibilityGuard", """'{"min_history_months":12,"documented_exceptions":["pregnancy","released_from_incarceration_within_6mo","prior_treatment_within_2yr"],"regulatory_basis":"42 CFR 8.12(e)(1)","maturity":"established","matrix_rule_number":38,"pending_reclassification":"engine2_nlp"}'""", "'1,42,8,12,1,6,2'", "true"),
    (4, 1, "R-FED-04", "Federal SAMHSA", "TAKEHOME", None, "TakeHomeStabilityGuard", """'{"blocking_factor":"stable_home_environment","all_factors":"42 CFR 8.12(i)(2)(i)-(viii)","regulatory_basis":"42 CFR 8.12(i)(2)","maturity":"established","matrix_rule_number":33}'""", "'42,8,12,2'", "true"),
    (4, 2, "R-FED-05", "Federal SAMHSA", "TAKEHOME", None, "TakeHomeStabilityGate", """'{"initial_window_days":14,"initial_cap_days":7,"cap_schedule_days":{"0-14":7,"15-31":14,"32+":28},"requires_stability_assessment":true,"stability_flag_field":"Stability_Assessment_Complete","regulatory_basis":"42 CFR 8.12(i)(2), 8.12(i)(3)(i) (2024 final rule)","maturity":"established","matrix_rule_number":8}'""", "'2024,1,1,14,7,42,8,12,3,2,42,8,12,2,14,7'", "true"),
    (4, 3, "R-FED-06", "Federal DEA", "VAULT", None, "ControlledSubstanceReconciliation", """'{"allowed_variance_mg":0,"regulatory_basis":"21 CFR 1304.21, 1304.22(c)","maturity":"established","matrix_rule_number":2}'""", "'21,1304,21,22'", "true"),
    (5, 0, "R-FLMAC-01", "Medicare", "G2067", None, "PayerBlocker", f"""'{{"enforce_g_codes":' || {_CODES('g_any')} || ',"block_standard_hcpcs":true}}'""", "'2067,2079'", "true"),
    (6, 0, "R-SUNSHINE-01", "Sunshine MCO", "H0020", None, "DiagnosisRequired", f"""'{{"required_dx_prefix":"F11.2","h_codes_in_scope":' || {_CODES('h')} || '}}'""", "'11,2'", "len(f11) > 0 and len(h) > 0"),
    (7, 0, "R-SIMPLY-01", "Simply MCO", "COUNSELING", None, "CounselingTimeMinimum", """'{"min_minutes":' || coalesce(minutes, 15) || '}'""", "coalesce(minutes, 15)", "true"),
    (8, 0, "R-FASAMS-01", "FL DCF/MSO", "INTAKE", None, "IntakeFieldValidation", """'{"matrix_rule_number":28,"required_field_groups":["demographic","employment"],"regulatory_basis":"FL DCF Pamphlet 155-2 (FASAMS data elements)","maturity":"evolving"}'""", "''", "true"),
    (8, 1, "R-FASAMS-02", "FL DCF/MSO", "ELIGIBILITY", None, "EligibilityExpiryWarning", """'{"matrix_rule_number":29,"warning_window_days":30,"regulatory_basis":"FL DCF financial eligibility / sliding-fee rules","maturity":"evolving"}'""", "'30'", "true"),
    (9, 0, "R-MSO-01", "Regional MSO", "ALL_SUD", None, "RegionalModifierRouting", """'{"matrix_rule_number":30,"regulatory_basis":"Regional MSO contracts (LSF, Central Florida Cares, etc.)","maturity":"contract"}'""", "''", "true"),
    (10, 0, "R-PDMP-01", "FL E-FORCSE", "PRESCRIBE", None, "PdmpQueryGate", """'{"matrix_rule_number":35,"regulatory_basis":"FL Statute 893.055(2)(a)","maturity":"established"}'""", "''", "true"),
    (13, 0, "R-CRED-01", "FL DCF Medicaid", "COUNSELING", None, "CredentialingBillingBlock", """'{"matrix_rule_number":36,"regulatory_basis":"FL Admin Code 65D-30.004 (personnel)","maturity":"established"}'""", "'65,30'", "true"),
    (13, 1, "R-TPLAN-01", "CARF/FL", "TREATMENT_PLAN", None, "TreatmentPlanExpiry", """'{"matrix_rule_number":37,"warning_window_days":14,"regulatory_basis":"CARF Behavioral Health standards + FL 65D-30.0046","maturity":"established"}'""", "'65,30,14'", "true"),
]
_FEDERAL_PLACES = "0, 1, 2, 4"


def _source_rules_sql() -> str:
    found = lambda pattern, group=1: f"list_sort(list_distinct(regexp_extract_all(text, '{pattern}', {group})))"
    rules = "\nunion all\n".join(
        f"select result_ord, place, {n} as template_ord, '{rule}' as rule_id, '{payer}' as payer_type, '{code}' as code, cast({'null' if mod is None else repr(mod)} as varchar) as required_modifier, "
        f"'{logic}' as logic_type, cast({params} as varchar) as params_json, cast({numbers} as varchar) as message_numbers from said where place = {place} and {condition}"
        for place, n, rule, payer, code, mod, logic, params, numbers, condition in _SOURCE_RULES
    )
    keys = ", ".join(f"'{k}'" for k in ALL_SOURCES)
    return f""",
src as (
  select doc_id as result_ord, doc_id % {len(ALL_SOURCES)} as place,
         text || case doc_id % 3 when 0 then ' H0020 and H0001 with F11.20; 25 min session.' when 1 then ' H2010 only.' else ' G0137 requires a minimum of twelve services.' end as text
  from fx_source_text where doc_id % 19 <> 5),
said as (
  select *, {found(X.RE_G_CODE_CMS)} as g_cms, {found(X.RE_G_CODE_ANY)} as g_any, {found(X.RE_H_CODE)} as h, {found(X.RE_F11, 0)} as f11,
         case when {_search('text', X.RE_WEEKLY_THRESHOLD)} then {_word_or_int(_first('text', X.RE_WEEKLY_THRESHOLD))} else 1 end as weekly,
         {_word_or_int(_first('text', X.RE_IOP_G0137))} as iop,
         nullif(list_min(list_transform(regexp_extract_all(text, '(?i){X.RE_COUNSELING_TIME}', 1), lambda x: try_cast(x as integer))), 0) as minutes
  from src),
rules as ({rules})
select row_number() over (order by case when place in ({_FEDERAL_PLACES}) then 0 else 1 end, result_ord, template_ord) - 1 as rule_ord,
       rule_id, payer_type, code, required_modifier, logic_type, ([{keys}])[place + 1] as source_key, params_json, message_numbers
from rules"""


@register(
    "rule_matrix_sources",
    covers=("M2", "M3", "M4", "M7", "M8", "M9", "M10", "M12", "M13", "M14", "M15", "M16", "M17", "M18", "M19"),
    oracle=FX.with_fixtures(_source_rules_sql(), "fx_source_text"),
)
def q_rule_matrix_sources(spark, sf_dir):
    """Rules of every source; of the message the numbers it names."""
    rules = M.build_rules(source_results(Tables(spark, sf_dir).documents), max_h_codes=25)
    numbers = F.array_join(F.regexp_extract_all("friendly_message", F.lit(r"(\d+)"), 1), ",")
    return rules.select(*[c for c in rules.columns if c != "friendly_message"], numbers.alias("message_numbers"))


@register(
    "matrix_provenance",
    covers=("M5",),
    oracle=FX.with_fixtures(
        _FACTS_SQL
        + """
select result_ord, source_key, content_sha256, fetched_at from facts
where not failed and not parsed_empty
  and source_key in ('cms_pub_100_04_ch39', 'cms_pub_100_02_ch17', 'fl_mac_fcso_otp', 'ecfr_42_part_8')""",
        "fx_results",
    ),
)
def q_matrix_provenance(spark, sf_dir):
    return M.provenance(matrix_results(Tables(spark, sf_dir).documents))


@register(
    "matrix_header",
    covers=("M6",),
    oracle=FX.with_fixtures(
        _FACTS_SQL
        + f""",
rules as ({M.duck_template_sql('facts')})
select '{RULE_SCHEMA_VERSION}' as schema_version, count(*) as rule_count from rules""",
        "fx_results",
    ),
)
def q_matrix_header(spark, sf_dir):
    rules = M.build_rules(matrix_results(Tables(spark, sf_dir).documents), numbered=False)
    return M.header(rules).drop("generated_at")


def ncci_inputs(part: DataFrame):
    """Two PTP tables from fx_ptp_rows: the text members as the Medicare table
    (result 0), the workbook as the Medicaid table (result 1)."""
    raw = raw_rows(part)
    tables = []
    for key, ord_, cond in (("cms_ncci_edits", 0, F.col("file_ord") < 2), ("cms_ncci_medicaid", 1, F.col("file_ord") == 2)):
        e = P.relevant_edits(raw.filter(cond)).select(
            F.lit(key).alias("source_key"), F.lit(ord_).cast("bigint").alias("result_ord"), "*"
        )
        tables.append(e)
    edits = M.number_edits(tables[0].unionByName(tables[1]))
    spark = part.sparkSession
    results = spark.createDataFrame(
        [(0, "cms_ncci_edits", "cms_ncci_edits", "", "", [], False), (1, "cms_ncci_medicaid", "cms_ncci_medicaid", "", "", [], False)],
        "result_ord bigint, source_key string, source_name string, fetched_at string, content_sha256 string, warnings array<string>, parsed_empty boolean",
    )
    return results, edits


@register(
    "ncci_bundle_rules",
    covers=("M11", "P5", "P6"),
    oracle=FX.with_fixtures(
        _STAGED_SQL.replace("from fx_ptp_rows),\nf as", "from fx_ptp_rows),\nf0 as").replace(
            "select * from r\n  where", "select *, case when file_ord < 2 then 'cms_ncci_edits' else 'cms_ncci_medicaid' end as tbl from r\n  where"
        ).replace("d as (", "f as (select * from f0),\nd as (").replace(
            "partition by column1, column2, edit_kind order by", "partition by tbl, column1, column2, edit_kind order by"
        )
        + """,
n as (select *, row_number() over (partition by tbl order by file_ord, row_ord) - 1 as i from d)
select row_number() over (order by case when tbl = 'cms_ncci_edits' then 0 else 1 end, i) - 1 as rule_ord,
       printf('%s-%04d', case when tbl = 'cms_ncci_edits' then 'R-NCCI' else 'R-NCCIMCD' end, i) as rule_id,
       case when tbl = 'cms_ncci_edits' then 'Standard Clearinghouse' else 'Medicaid Clearinghouse' end as payer_type,
       column1 as code, cast(null as varchar) as required_modifier, 'BundleGuard' as logic_type, tbl as source_key,
       printf('NCCI PTP edit: %s cannot be billed on the same day as %s without an appropriate modifier.', column1, column2)
         as friendly_message,
       cast(json_object('mutually_exclusive_with', column2) as varchar) as params_json
from n""",
        "fx_ptp_rows",
    ),
)
def q_ncci_bundle_rules(spark, sf_dir):
    results, edits = ncci_inputs(Tables(spark, sf_dir).part)
    return M.build_rules(results, edits).filter(F.col("logic_type") == "BundleGuard")


def _coverage_values() -> str:
    from regloom.operators.coverage import COVERAGE

    def q(v):
        return "'" + str(v).replace("'", "''") + "'"

    rows = ",\n  ".join(f"({n}, {q(f)}, {q(i)}, {q(k)}, {q(st)}, {q(m)})" for n, f, i, k, st, m in COVERAGE)
    return f"cov(rule_number, focus, rule_ids, source_keys, status, maturity) as (values\n  {rows})"


def _rule_coverage_oracle() -> str:
    from regloom.plans.registry import _REGISTRY

    matrix = _REGISTRY["rule_matrix"].oracle.strip()
    return f"""
with {_coverage_values()},
built as (select regexp_replace(rule_id, '^(R-NCCI(?:MCD)?)-\\d+$', '\\1-*') as family, count(*) as n
          from ({matrix}) m group by 1),
ids as (select rule_number, unnest(list_filter(string_split(rule_ids, ','), lambda x: x <> '')) as family from cov),
per as (select cov.rule_number, cast(coalesce(sum(built.n), 0) as bigint) as built_rule_count
        from cov left join ids using (rule_number) left join built using (family) group by cov.rule_number)
select cast(rule_number as integer) as rule_number, focus, rule_ids, source_keys, status, maturity, built_rule_count
from cov join per using (rule_number)"""


@register("rule_coverage", covers=("M20", "M19", "S1"), oracle=_rule_coverage_oracle())
def q_rule_coverage(spark, sf_dir):
    rules = M.build_rules(matrix_results(Tables(spark, sf_dir).documents), numbered=False)
    return coverage_report(spark, rules)
