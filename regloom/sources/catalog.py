"""Source catalog (S1), selection (S2) and extractor registry (S3).

The catalog is a fixed 32-row dimension table; it is broadcast by size, never
shuffled. ``catalog_ord`` keeps the published order, which decides result
order downstream.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("catalog_ord", T.IntegerType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("cadence", T.StringType(), False),
        T.StructField("engine", T.StringType(), False),
        T.StructField("fetch_mode", T.StringType(), False),
    ]
)

# The policy source catalog in its published order
# (key, name, url, cadence, engine, fetch_mode).
SOURCES: list[tuple[str, str, str, str, str, str]] = [
    ("cms_pub_100_04_ch39", "CMS IOM Pub 100-04, Medicare Claims Processing Manual, Ch 39 (OTP)", "https://www.cms.gov/files/document/chapter-39-opioid-treatment-programs-otps.pdf", "monthly", "engine1", "pdf"),
    ("cms_pub_100_02_ch17", "CMS IOM Pub 100-02, Medicare Benefit Policy Manual, Ch 17 (OTP)", "https://www.cms.gov/files/document/chapter-17-opioid-treatment-programs-otps.pdf", "monthly", "engine1", "pdf"),
    ("cms_mln_otp_booklet", "CMS MLN Booklet — OTP Medicare Billing & Payment (MLN8296732)", "https://www.cms.gov/sites/default/files/2021-12/2021_12_MLN8296732_OTP_Billing_Payment_FINAL_0.pdf", "bi-annually", "engine1", "pdf"),
    ("fl_ahca_cbh_handbook", "Florida AHCA — Community Behavioral Health Services Handbook", "https://ahca.myflorida.com/medicaid/medicaid-policy-quality-and-operations/medicaid-policy-and-quality/medicaid-policy/medical-and-behavioral-health-coverage-policy/behavioral-health-and-health-facilities/community-behavioral-health-services", "quarterly", "engine1", "selenium"),
    ("fl_mac_fcso_otp", "FCSO (Medicare FL MAC) — OTP Specialty Page", "https://medicare.fcso.com/specialties/otp", "bi-annually", "engine1", "html"),
    ("cms_ncci_edits", "CMS NCCI PTP Edits — Practitioner (full table)", "https://www.cms.gov/medicare/coding-billing/national-correct-coding-initiative-ncci-edits/medicare-ncci-procedure-procedure-ptp-edits", "quarterly", "engine1", "html"),
    ("cms_ncci_medicaid", "CMS NCCI Medicaid PTP Edits (H-codes / H0020)", "https://www.cms.gov/medicare/coding-billing/ncci-medicaid/medicaid-ncci-edit-files", "quarterly", "engine1", "html"),
    ("sunshine_provider_manual", "Sunshine Health (Centene MCO) — Provider Manual", "https://www.sunshinehealth.com/content/dam/centene/Sunshine/pdfs/Provider%20Manual.pdf", "monthly", "engine1", "pdf"),
    ("simply_provider_resources", "Simply Healthcare — FL Healthy Kids Provider Manual", "https://provider.simplyhealthcareplans.com/docs/gpp/FLFL_SMH_FHKProviderManual.pdf", "quarterly", "engine1", "pdf"),
    ("fl_ahca_carf_ai_consent", "FL AHCA / CARF — AI Patient Consent & Transparency (Rule 32)", "https://ahca.myflorida.com/health-care-policy-and-oversight/bureau-of-central-services/rule-promulgation", "quarterly", "engine1", "selenium"),
    ("internal_policy", "Internal / Corporate Policy (Rule 11 — No-Pay take-home flag)", "", "ad-hoc", "engine1", "html"),
    ("fl_dcf_fasams", "FL DCF FASAMS — Pamphlet 155-2 (Rules 28, 29 — intake data + eligibility)", "https://www.myflfamilies.com/services/samh/fasams", "quarterly", "engine1", "html"),
    ("fl_mso_contracts", "FL Regional Managing Entities (MSO) — modifier routing (Rule 30)", "https://www.myflfamilies.com/services/samh/managing-entities", "quarterly", "engine1", "html"),
    ("fl_eforcse_pdmp", "FL E-FORCSE PDMP — mandatory query (Rule 35)", "https://e-forcse.com/", "annually", "engine1", "html"),
    ("fl_65d30_fac", "FL Admin Code 65D-30 — personnel + treatment planning (Rules 36, 37)", "https://www.flrules.org/gateway/ChapterHome.asp?Chapter=65d-30", "annually", "engine1", "html"),
    ("ecfr_42_part_8", "42 CFR Part 8 — Medications for Treatment of Opioid Use Disorder", "https://www.ecfr.gov", "ad-hoc", "engine2", "json-api"),
    ("samhsa_tip_63", "SAMHSA Treatment Improvement Protocol (TIP) 63 — MAT", "https://store.samhsa.gov/sites/default/files/pep21-02-01-002.pdf", "bi-annually", "engine2", "pdf"),
    ("cdc_icd10_z_codes", "CDC ICD-10-CM — Official Guidelines incl. SDOH Z-Codes (FY 2026)", "https://ftp.cdc.gov/pub/Health_Statistics/NCHS/Publications/ICD10CM/2026/ICD-10-CM-October-2025-Guidelines.pdf", "annually", "engine2", "pdf"),
    ("asam_criteria", "ASAM Criteria, 4th Edition — Patient Placement / Step-down", "https://www.asam.org/asam-criteria", "ad-hoc", "engine2", "html"),
    ("cfr_42_part_2", "42 CFR Part 2 (Subpart C) — Confidentiality of SUD Records / Consent", "https://www.ecfr.gov", "annually", "engine2", "json-api"),
    ("corporate_clinical_policy", "Corporate Clinical Policy — Patient Rights + Code of Ethics (Rules 6, 7)", "", "ad-hoc", "engine2", "html"),
    ("aatod_guidelines", "AATOD Guidelines — discharge/retention, SDOH, co-occurring (Rules 8, 9, 19)", "https://www.aatod.org/", "annually", "engine2", "html"),
    ("nida_principles", "NIDA Principles of Drug Addiction Treatment (Rules 10, 18, 21)", "https://nida.nih.gov/publications/principles-drug-addiction-treatment-research-based-guide-third-edition", "annually", "engine2", "html"),
    ("fl_marchman_act", "FL Marchman Act — Ch. 397 (Rule 15 — impaired/AMA discharge)", "http://www.leg.state.fl.us/statutes/index.cfm?App_mode=Display_Statute&URL=0300-0399/0397/0397.html", "annually", "engine2", "html"),
    ("fl_baker_act", "FL Baker Act — Ch. 394 Part I (Rule 16 — psychiatric vs. substance crisis)", "http://www.leg.state.fl.us/statutes/index.cfm?App_mode=Display_Statute&URL=0300-0399/0394/0394.html", "annually", "engine2", "html"),
    ("fda_rems_methadone", "FDA REMS — methadone cardiac toxicity / high-dose EKG (Rule 17)", "https://www.accessdata.fda.gov/scripts/cder/rems/index.cfm", "bi-annually", "engine2", "html"),
    ("hhs_oig_compliance", "HHS OIG Compliance — note cloning / copy-paste fraud (Rule 20)", "https://oig.hhs.gov/compliance/compliance-guidance/", "annually", "engine2", "html"),
    ("carf_standards", "CARF Behavioral Health Standards — integrated primary care (Rule 22)", "https://www.carf.org/programs/bh/", "annually", "engine2", "html"),
    ("samhsa_sor_grant", "SAMHSA SOR Grant — Naloxone/Narcan distribution audit (Rule 23)", "https://www.samhsa.gov/grants/grant-announcements", "annually", "engine2", "html"),
    ("hrsa_rcorp", "HRSA RCORP — rural SDOH barriers (Rule 24)", "https://www.hrsa.gov/rural-health/grants/rural-community-opioid", "annually", "engine2", "html"),
    ("samhsa_sabg", "SAMHSA SABG Block Grant — 48-hour priority admission (Rule 25)", "https://www.samhsa.gov/grants/block-grants/sabg", "annually", "engine2", "html"),
    ("dea_mobile_otp", "DEA Mobile OTP — dispensing security / GPS inventory (Rule 27)", "https://www.deadiversion.usdoj.gov/", "annually", "engine2", "html"),
]

# Source keys that have an extractor, in registry order.
EXTRACTOR_KEYS = [
    "cms_pub_100_04_ch39",
    "cms_pub_100_02_ch17",
    "cms_mln_otp_booklet",
    "fl_ahca_cbh_handbook",
    "fl_mac_fcso_otp",
    "cms_ncci_edits",
    "cms_ncci_medicaid",
    "ecfr_42_part_8",
    "samhsa_tip_63",
    "cdc_icd10_z_codes",
    "sunshine_provider_manual",
    "simply_provider_resources",
]

ENGINE1_KEYS = [s[0] for s in SOURCES if s[4] == "engine1"]
ENGINE2_KEYS = [s[0] for s in SOURCES if s[4] == "engine2"]
ENGINE2_KEYS_SQL = ", ".join(f"'{k}'" for k in ENGINE2_KEYS)


def catalog_df(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(SOURCES)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def by_key(catalog: DataFrame, keys: DataFrame, key_col: str = "source_key") -> DataFrame:
    """S1 lookup: rows of ``keys`` joined with their catalog entry.

    An unknown key is an error, as in the reference (KeyError); the check is a
    left-anti join against the broadcast catalog, surfaced through
    ``assert_true`` so no data goes to the driver.
    """
    cat = F.broadcast(catalog.withColumnRenamed("key", key_col))
    joined = keys.join(cat, key_col, "left")
    known = F.assert_true(F.col("catalog_ord").isNotNull(), F.concat(F.lit("Unknown source key: "), F.col(key_col)))
    # Folded into a kept column so column pruning cannot drop the check.
    return joined.withColumn("catalog_ord", F.coalesce(known.cast("int"), F.col("catalog_ord")))


def select_sources(catalog: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Empty or None means all; unknown keys are ignored; catalog order kept."""
    if not only:
        return catalog
    return catalog.filter(F.col("key").isin(list(only)))


def registered(catalog: DataFrame, spark: SparkSession) -> DataFrame:
    """S3: only sources with an extractor yield a result row (left-semi)."""
    reg = spark.createDataFrame([(k,) for k in EXTRACTOR_KEYS], "key string")
    return catalog.join(F.broadcast(reg), "key", "left_semi")
