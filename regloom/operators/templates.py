"""Rule templates as data.

One row per (source_key, template): the matrix job joins results with this
fixed table (19 rows, broadcast by size) instead of running per-source code.
Message arguments and parameter values are SQL expressions over the fact
columns, written in the subset both Spark SQL and DuckDB accept, so the same
definitions also render the DuckDB oracle.

Value specs for params:
  plain Python value  -> a literal (str, int, bool, list of str, dict str->int)
  Expr(spark, duck)   -> an expression over fact columns (duck defaults to spark)
"""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Expr:
    spark: str
    duck: str | None = None

    def for_duck(self) -> str:
        return self.duck or self.spark


@dataclass(frozen=True)
class Template:
    source_key: str
    template_ord: int
    rule_id: str
    payer_type: str
    code: str
    required_modifier: str | None
    logic_type: str
    message: str  # printf-style, %s only
    message_args: tuple[Expr, ...] = ()
    params: tuple[tuple[str, object], ...] = ()
    condition: Expr | None = None


# Fact columns the templates read, with their types. A missing fact is null;
# the templates apply the reference's defaults with coalesce.
FACT_TYPES = {
    "weekly_bundle_min_services": "bigint",
    "g_codes_mentioned": "array<string>",
    "iop_threshold_services": "bigint",
    "iop_window_days": "int",
    "h_codes_referenced": "array<string>",
    "requires_dx_with_h_codes": "boolean",
    "min_counseling_threshold_minutes": "int",
    "min_counseling_per_dosing_days": "int",
    "dosing_ratio_window_days": "int",
    "admission_min_history_months": "int",
    "initial_window_days": "int",
    "initial_cap_days": "int",
    "allowed_variance_mg": "int",
    "eligibility_warning_days": "int",
    "plan_warning_days": "int",
}

# Source keys whose rules are federal (emitted before the others).
FEDERAL_KEYS = ["cms_pub_100_04_ch39", "cms_pub_100_02_ch17", "cms_mln_otp_booklet", "ecfr_42_part_8"]

# Rule matrix schema version and NCCI rule namespaces.
RULE_SCHEMA_VERSION = "2026.05.22"
NCCI_KEYS = {"cms_ncci_edits": ("R-NCCI", "Standard Clearinghouse"), "cms_ncci_medicaid": ("R-NCCIMCD", "Medicaid Clearinghouse")}
NCCI_MESSAGE = "NCCI PTP edit: %s cannot be billed on the same day as %s without an appropriate modifier."


def _c(col: str, default) -> Expr:
    return Expr(f"coalesce({col}, {default})")


def _s(col: str, default) -> Expr:
    """Fact rendered for a message: the default when absent, as text."""
    return Expr(f"cast(coalesce({col}, {default}) as string)", f"cast(coalesce({col}, {default}) as varchar)")


# Rule templates (ids, payers, codes, modifiers, logic types,
# messages and parameters) in builder order per source.
TEMPLATES: tuple[Template, ...] = (
    Template(
        "cms_pub_100_04_ch39", 0, "R-FED-01", "Medicare Advantage", "G2067", None, "BundleValidation",
        "Medicare OTP weekly bundle (G2067–G2079) must include at least %s qualifying service within a %s-day window. "
        "Billing the bundle without an in-window service will be denied per CMS Pub 100-04 Ch 39.",
        (_s("weekly_bundle_min_services", 1), Expr("'7'")),
        (
            ("min_services_in_bundle", _c("weekly_bundle_min_services", 1)),
            ("window_days", 7),
            ("g_codes_in_scope", Expr("coalesce(g_codes_mentioned, array())", "coalesce(g_codes_mentioned, []::varchar[])")),
        ),
    ),
    Template(
        "cms_pub_100_02_ch17", 0, "R-FED-02", "Medicare", "G0137", None, "IopThresholdGuard",
        "Medicare IOP add-on G0137 requires at least %s qualifying services in a %s-day window. Below this threshold "
        "the claim does not meet IOP medical-necessity criteria in CMS Pub 100-02 Ch 17.",
        (_s("iop_threshold_services", "NULL"), _s("iop_window_days", 7)),
        (("required_services", Expr("iop_threshold_services")), ("window_days", _c("iop_window_days", 7))),
        condition=Expr("coalesce(iop_threshold_services, 0) <> 0"),
    ),
    Template(
        "fl_ahca_cbh_handbook", 0, "R-FL-02", "Managed Medicaid", "H0020", "POS-58", "PointOfCareBlock",
        "FL Managed Medicaid requires methadone administration (H0020) to be billed at Place-of-Service 58 "
        "(non-residential SUD facility). Other POS values will be rejected by AHCA.",
    ),
    Template(
        "fl_ahca_cbh_handbook", 1, "R-FL-03", "AHCA Medicaid", "ALL_SUD", "HF", "SubstanceAbuseModifier",
        "FL AHCA Medicaid SUD services must carry the HF modifier (substance abuse program). Claims missing HF on "
        "SUD codes will be denied.",
    ),
    Template(
        "fl_ahca_cbh_handbook", 2, "R-FL-04", "AHCA Medicaid", "H0020", "HD>HG", "ModifierSequencer",
        "When H0020 is billed for a pregnant patient (ICD-10 prefix O…), modifier HD (pregnant/parenting program) "
        "must appear before HG (opioid addiction treatment); otherwise use HG alone.",
        params=(("trigger_icd_prefix", "O"), ("alt_modifier", "HG")),
    ),
    Template(
        "fl_ahca_cbh_handbook", 3, "R-FL-05", "AHCA Medicaid", "H0020", None, "DosingCounselingRatio",
        "FL Medicaid requires methadone dosing (H0020) to be matched by counseling: at least %s documented "
        "counseling session per %s-day window. Dosing that outruns the counseling ratio fails AHCA "
        "medical-necessity review and is a clawback risk.",
        (_s("min_counseling_per_dosing_days", 1), _s("dosing_ratio_window_days", 30)),
        (
            ("min_counseling_sessions", _c("min_counseling_per_dosing_days", 1)),
            ("window_days", _c("dosing_ratio_window_days", 30)),
            ("regulatory_basis", "FL AHCA Community Behavioral Health Services Handbook"),
            ("maturity", "evolving"),
            ("matrix_rule_number", 4),
        ),
    ),
    Template(
        "ecfr_42_part_8", 0, "R-FED-03", "Federal SAMHSA", "ADMISSION", None, "AdmissionEligibilityGuard",
        "SAMHSA requires a documented 1-year history of opioid addiction before admission to methadone maintenance "
        "(42 CFR 8.12(e)(1)). Admit without it only under a documented exception (pregnancy, release from "
        "incarceration within 6 months, or prior treatment within 2 years); otherwise the admission is non-compliant.",
        params=(
            ("min_history_months", _c("admission_min_history_months", 12)),
            ("documented_exceptions", ["pregnancy", "released_from_incarceration_within_6mo", "prior_treatment_within_2yr"]),
            ("regulatory_basis", "42 CFR 8.12(e)(1)"),
            ("maturity", "established"),
            ("matrix_rule_number", 38),
            ("pending_reclassification", "engine2_nlp"),
        ),
    ),
    Template(
        "ecfr_42_part_8", 1, "R-FED-04", "Federal SAMHSA", "TAKEHOME", None, "TakeHomeStabilityGuard",
        "Unsupervised (take-home) methadone requires the practitioner to find the patient stable across the "
        "42 CFR 8.12(i)(2) factors — including a stable home environment. Patients lacking secure housing fail "
        "this factor; block the take-home and route to supervised dosing until the determination is documented.",
        params=(
            ("blocking_factor", "stable_home_environment"),
            ("all_factors", "42 CFR 8.12(i)(2)(i)-(viii)"),
            ("regulatory_basis", "42 CFR 8.12(i)(2)"),
            ("maturity", "established"),
            ("matrix_rule_number", 33),
        ),
    ),
    Template(
        "ecfr_42_part_8", 2, "R-FED-05", "Federal SAMHSA", "TAKEHOME", None, "TakeHomeStabilityGate",
        "2024 SAMHSA take-home gate. Day-1 take-homes are now permitted for stable patients, but (1) during the "
        "first %s days the supply is capped at %s days (42 CFR 8.12(i)(3)(i)), and (2) the Medical Director's "
        "risk/benefit Stability Assessment must be signed in the chart first (42 CFR 8.12(i)(2)). Block the "
        "dispense if days_in_treatment < %s AND requested take-home days > %s, OR if the Stability Assessment "
        "is not documented.",
        (
            _s("initial_window_days", 14),
            _s("initial_cap_days", 7),
            _s("initial_window_days", 14),
            _s("initial_cap_days", 7),
        ),
        (
            ("initial_window_days", _c("initial_window_days", 14)),
            ("initial_cap_days", _c("initial_cap_days", 7)),
            ("cap_schedule_days", {"0-14": 7, "15-31": 14, "32+": 28}),
            ("requires_stability_assessment", True),
            ("stability_flag_field", "Stability_Assessment_Complete"),
            ("regulatory_basis", "42 CFR 8.12(i)(2), 8.12(i)(3)(i) (2024 final rule)"),
            ("maturity", "established"),
            ("matrix_rule_number", 8),
        ),
    ),
    Template(
        "ecfr_42_part_8", 3, "R-FED-06", "Federal DEA", "VAULT", None, "ControlledSubstanceReconciliation",
        "The daily methadone vault must reconcile to zero variance: beginning inventory + receipts − dispensed − "
        "wasted must equal the physical count. Any non-zero variance is a DEA recordkeeping violation "
        "(21 CFR 1304.21–.22) and must block end-of-day close.",
        params=(
            ("allowed_variance_mg", _c("allowed_variance_mg", 0)),
            ("regulatory_basis", "21 CFR 1304.21, 1304.22(c)"),
            ("maturity", "established"),
            ("matrix_rule_number", 2),
        ),
    ),
    Template(
        "fl_mac_fcso_otp", 0, "R-FLMAC-01", "Medicare", "G2067", None, "PayerBlocker",
        "FCSO (FL Medicare MAC) accepts only OTP G-codes (G2067–G2079) for OTP services. Standard HCPCS/CPT codes "
        "will be rejected on OTP claims.",
        params=(
            ("enforce_g_codes", Expr("coalesce(g_codes_mentioned, array())", "coalesce(g_codes_mentioned, []::varchar[])")),
            ("block_standard_hcpcs", True),
        ),
    ),
    Template(
        "sunshine_provider_manual", 0, "R-SUNSHINE-01", "Sunshine MCO", "H0020", None, "DiagnosisRequired",
        "Sunshine Health requires an F11.2x (opioid dependence) diagnosis on the claim whenever MAT H-codes are "
        "billed. Missing diagnosis will cause the claim to be denied.",
        params=(
            ("required_dx_prefix", "F11.2"),
            (
                "h_codes_in_scope",
                Expr("coalesce(h_codes_referenced, array())", "list_slice(coalesce(h_codes_referenced, []::varchar[]), 1, 25)"),
            ),
        ),
        condition=Expr("coalesce(requires_dx_with_h_codes, false)"),
    ),
    Template(
        "simply_provider_resources", 0, "R-SIMPLY-01", "Simply MCO", "COUNSELING", None, "CounselingTimeMinimum",
        "Simply Healthcare requires documented counseling time of at least %s minutes in the clinical narrative. "
        "Shorter sessions will trigger a billing warning and may be denied on audit.",
        (_s("nullif(min_counseling_threshold_minutes, 0)", 15),),
        (("min_minutes", _c("nullif(min_counseling_threshold_minutes, 0)", 15)),),
    ),
    Template(
        "fl_dcf_fasams", 0, "R-FASAMS-01", "FL DCF/MSO", "INTAKE", None, "IntakeFieldValidation",
        "FL Managing Entity (MSO) invoices require the FASAMS mandatory demographic and employment fields to be "
        "complete at intake. Missing fields cause state-funded invoice rejection — block intake completion until "
        "they are filled.",
        params=(
            ("matrix_rule_number", 28),
            ("required_field_groups", ["demographic", "employment"]),
            ("regulatory_basis", "FL DCF Pamphlet 155-2 (FASAMS data elements)"),
            ("maturity", "evolving"),
        ),
    ),
    Template(
        "fl_dcf_fasams", 1, "R-FASAMS-02", "FL DCF/MSO", "ELIGIBILITY", None, "EligibilityExpiryWarning",
        "Financial eligibility re-assessment is due within %s days. Bill against an expired determination and the "
        "state can claw the funds back — warn staff to re-assess before it lapses.",
        (_s("eligibility_warning_days", 30),),
        (
            ("matrix_rule_number", 29),
            ("warning_window_days", _c("eligibility_warning_days", 30)),
            ("regulatory_basis", "FL DCF financial eligibility / sliding-fee rules"),
            ("maturity", "evolving"),
        ),
    ),
    Template(
        "fl_mso_contracts", 0, "R-MSO-01", "Regional MSO", "ALL_SUD", None, "RegionalModifierRouting",
        "FL is carved into regional Managing Entities (e.g. LSF vs. Central Florida Cares) with different billing "
        "modifiers. Apply the modifier set for the patient's region before submitting, or the MSO will reject the claim.",
        params=(
            ("matrix_rule_number", 30),
            ("regulatory_basis", "Regional MSO contracts (LSF, Central Florida Cares, etc.)"),
            ("maturity", "contract"),
        ),
    ),
    Template(
        "fl_eforcse_pdmp", 0, "R-PDMP-01", "FL E-FORCSE", "PRESCRIBE", None, "PdmpQueryGate",
        "Florida law requires the prescriber to check the E-FORCSE PDMP before prescribing a controlled substance. "
        "Confirm a documented PDMP query for this patient before the prescription is finalized.",
        params=(
            ("matrix_rule_number", 35),
            ("regulatory_basis", "FL Statute 893.055(2)(a)"),
            ("maturity", "established"),
        ),
    ),
    Template(
        "fl_65d30_fac", 0, "R-CRED-01", "FL DCF Medicaid", "COUNSELING", None, "CredentialingBillingBlock",
        "Counseling billed under an unlicensed counselor must have a qualified supervisor of record (FL 65D-30 "
        "personnel standards). Block billing for sessions lacking documented supervision — unsupervised counselor "
        "time is a retroactive Medicaid clawback.",
        params=(
            ("matrix_rule_number", 36),
            ("regulatory_basis", "FL Admin Code 65D-30.004 (personnel)"),
            ("maturity", "established"),
        ),
    ),
    Template(
        "fl_65d30_fac", 1, "R-TPLAN-01", "CARF/FL", "TREATMENT_PLAN", None, "TreatmentPlanExpiry",
        "Treatment plans must be reviewed/updated on the required cadence (CARF + FL 65D-30). Alert staff %s days "
        "before this patient's plan expires so a CARF survey never finds a lapsed plan.",
        (_s("plan_warning_days", 14),),
        (
            ("matrix_rule_number", 37),
            ("warning_window_days", _c("plan_warning_days", 14)),
            ("regulatory_basis", "CARF Behavioral Health standards + FL 65D-30.0046"),
            ("maturity", "established"),
        ),
    ),
)

# Keys that have a builder (M2): template sources plus the two NCCI tables.
BUILDER_KEYS = sorted({t.source_key for t in TEMPLATES} | set(NCCI_KEYS))

# Sources registered but deliberately without rules.
DEFERRED_KEYS = ["internal_policy", "fl_ahca_carf_ai_consent"]
