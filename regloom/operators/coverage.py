"""Rule coverage table (M20): master-matrix rule number -> rule ids, source, status.

A fixed 36-row table joined with the built rules. NCCI rule ids are folded to
their family ('R-NCCI-*') so the join is an equi-join on a small broadcast side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Master-matrix coverage (rule number, focus, rule ids, source keys,
# status, maturity). Engine 1 first, then the engine-2 corpus rows.
COVERAGE = [
    (1, "Take-home dispensing criteria", "R-FED-04,R-FED-05", "ecfr_42_part_8", "live", "established / evolving"),
    (2, "Medicare/Medicaid unbundling", "R-FED-01,R-NCCI-*,R-NCCIMCD-*", "cms_pub_100_04_ch39,cms_ncci_edits,cms_ncci_medicaid", "live", ""),
    (3, "POS-58 facility modifier", "R-FL-02", "fl_ahca_cbh_handbook", "live", ""),
    (4, "'HF' substance-abuse modifier", "R-FL-03", "fl_ahca_cbh_handbook", "live", ""),
    (5, "Dosing-to-counseling ratio", "R-FL-05", "fl_ahca_cbh_handbook", "live", "evolving"),
    (11, "\"No-Pay, No Take-Home\" check", "", "internal_policy", "deferred", "policy — pending sign-off"),
    (13, "SDOH housing → take-home block", "R-FED-04", "ecfr_42_part_8", "live", "established"),
    (28, "FASAMS intake data validation", "R-FASAMS-01", "fl_dcf_fasams", "defined", "evolving"),
    (29, "Financial eligibility re-assess", "R-FASAMS-02", "fl_dcf_fasams", "defined", "evolving"),
    (30, "Regional MSO modifier routing", "R-MSO-01", "fl_mso_contracts", "defined", "contract"),
    (32, "AI patient consent gate", "", "fl_ahca_carf_ai_consent", "deferred", "not enacted law — pending sign-off"),
    (33, "1-year opioid-history admission", "R-FED-03", "ecfr_42_part_8", "live", "established"),
    (34, "DEA vault reconciliation", "R-FED-06", "ecfr_42_part_8", "live", "established"),
    (35, "Mandatory PDMP (E-FORCSE) query", "R-PDMP-01", "fl_eforcse_pdmp", "defined", "established"),
    (36, "Clinical supervision / credentialing", "R-CRED-01", "fl_65d30_fac", "defined", "established"),
    (37, "Treatment-plan expiration", "R-TPLAN-01", "fl_65d30_fac", "defined", "established"),
    (6, "Patient rights & responsibilities", "", "corporate_clinical_policy", "corpus", ""),
    (7, "Code of ethics (objective tone)", "", "corporate_clinical_policy", "corpus", ""),
    (8, "Admin discharge / retention", "", "aatod_guidelines", "corpus", ""),
    (9, "Medicare SDOH documentation", "", "aatod_guidelines,cdc_icd10_z_codes", "corpus", ""),
    (10, "90-day efficacy / dropout risk", "", "nida_principles", "corpus", ""),
    (12, "SDOH: transportation insecurity", "", "cdc_icd10_z_codes", "corpus", ""),
    (14, "SDOH: food / financial insecurity", "", "cdc_icd10_z_codes", "corpus", ""),
    (15, "FL Marchman Act — impaired/AMA", "", "fl_marchman_act", "corpus", ""),
    (16, "FL Baker Act — psych vs. substance", "", "fl_baker_act", "corpus", ""),
    (17, "FDA REMS — cardiac/EKG", "", "fda_rems_methadone", "corpus", ""),
    (18, "Polysubstance / xylazine alerts", "", "nida_principles", "corpus", ""),
    (19, "Co-occurring medical (Hep-C/HIV)", "", "aatod_guidelines", "corpus", ""),
    (20, "Note cloning / copy-paste fraud", "", "hhs_oig_compliance", "corpus", ""),
    (21, "Post-relapse plan modification", "", "nida_principles", "corpus", ""),
    (22, "Integrated primary care", "", "carf_standards", "corpus", ""),
    (23, "Naloxone / Narcan distribution", "", "samhsa_sor_grant", "corpus", ""),
    (24, "Rural SDOH barriers", "", "hrsa_rcorp", "corpus", ""),
    (25, "48-hour priority admission", "", "samhsa_sabg", "corpus", ""),
    (26, "Suboxone precipitated withdrawal", "", "asam_criteria", "corpus", ""),
    (27, "Mobile OTP dispensing security", "", "dea_mobile_otp", "corpus", ""),
]


def coverage_table(spark: SparkSession) -> DataFrame:
    schema = "rule_number int, focus string, rule_ids string, source_keys string, status string, maturity string"
    return spark.createDataFrame(COVERAGE, schema)


def rule_family(rule_id):
    """'R-NCCI-0042' -> 'R-NCCI-*'; template ids are their own family."""
    return F.regexp_replace(rule_id, r"^(R-NCCI(?:MCD)?)-\d+$", "$1-*")


def coverage_report(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """Per master-matrix rule: its status and how many built rules it covers."""
    built = rules.groupBy(rule_family(F.col("rule_id")).alias("family")).agg(F.count(F.lit(1)).alias("n"))
    cov = coverage_table(spark)
    ids = cov.select(
        "rule_number", F.explode_outer(F.filter(F.split("rule_ids", ","), lambda x: x != "")).alias("family")
    )
    per = ids.join(built, "family", "left").groupBy("rule_number").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("built_rule_count")
    )
    return F.broadcast(cov).join(per, "rule_number").select(
        "rule_number", "focus", "rule_ids", "source_keys", "status", "maturity", "built_rule_count"
    )


def status_totals(spark: SparkSession) -> DataFrame:
    """Engine-1 status totals (the document states 8 live / 6 defined / 2 deferred)."""
    cov = coverage_table(spark).filter(F.col("status") != "corpus")
    return cov.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
