"""Text extractors (X1-X12) and per-source extractor jobs.

Each extractor is a set of column expressions over a text column: regex
search / find-all / replace run in the JVM inside whole-stage codegen, one
row at a time, with no shuffle. ``extract_facts`` evaluates every source's
extractor in ONE projection (CASE on source_key), so a mixed results table is
scanned once no matter how many sources it holds.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions import regex as R

# Extraction patterns (Python re syntax; flags noted per use).
RE_G_CODE_CMS = r"\b(G20[67]\d)\b"
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]
NUMBER_WORD = r"(?:\d+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)"
RE_IOP_G0137 = rf"G0137[\s\S]{{0,400}}?({NUMBER_WORD})\s+(?:distinct\s+)?services?"  # ignore case
RE_WEEKLY_THRESHOLD = (  # ignore case
    rf"(?:at\s+least|minimum\s+of)\s+({NUMBER_WORD})\s+services?\s+(?:per|every|in\s+a)\s+7[-\s]?day"
)
RE_TAKEHOME = r"(take[-\s]?home|unsupervised)\s+(?:dose|medication)"  # ignore case
RE_G_CODE_ANY = r"\b(G\d{4})\b"
RE_H_CODE = r"\b(H\d{4})\b"
RE_F11 = r"\bF11\.\d{1,3}[A-Z]?\b"
RE_SDOH_Z = r"\bZ5[5-9]\.\d+x?\b|\bZ6[0-5]\.\d+x?\b"
RE_COUNSELING_TIME = r"(\d{1,3})\s*(?:minute|min)\b.{0,80}?(?:counsel|therap|session)"  # ignore case
RE_TEMPLATE_PLACEHOLDER = r"\[\s*Grab your reader.s attention[\s\S]*?\]\s*"  # ignore case
RE_HF = r"\bHF\b\s*modifier|\bmodifier\s+HF\b"  # ignore case
RE_POS_58 = r"POS[\s-]?58|place\s+of\s+service\s+58"  # ignore case
RE_HD_HG = r"\bHD\b.*?\bHG\b|\bHG\b.*?\bHD\b"  # ignore case, dot matches newline
RE_POLYSUBSTANCE = r"(benzodiazepine|alprazolam|polysubstance|alcohol\s+use|drank\s+alcohol)"  # ignore case
ECFR_ARTIFACT = "thnsp;"
EXCERPT_CHARS = 2000
HANDBOOK_EXCERPT_CHARS = 1500
POLYSUBSTANCE_LIMIT = 50  # fixed value: the limit of the parity query
IOP_WINDOW_DAYS = 7
WEEKLY_DEFAULT = 1


# ------------------------------------------------------------------ columns
def word_or_int(token: Column) -> Column:
    """'nine' -> 9, '12' -> 12 (number words are matched case-insensitively).

    Digits go through ``try_cast`` so free text never raises under ANSI mode;
    a number beyond BIGINT gives null.
    """
    words = F.create_map(*[x for i, w in enumerate(NUMBER_WORDS, 1) for x in (F.lit(w), F.lit(i))])
    low = F.lower(R.py_strip(token))
    return F.coalesce(F.try_element_at(words, low).cast("bigint"), low.try_cast("bigint"))


def cms_g_codes(text: Column) -> Column:
    """Sorted distinct G2060..G2079 mentions (case-sensitive)."""
    return R.sorted_distinct(text, RE_G_CODE_CMS, 1)


def any_g_codes(text: Column) -> Column:
    """X1b."""
    return R.sorted_distinct(text, RE_G_CODE_ANY, 1)


def any_h_codes(text: Column) -> Column:
    """X1b."""
    return R.sorted_distinct(text, RE_H_CODE, 1)


def f11_codes(text: Column) -> Column:
    """Opioid-dependence diagnoses (whole match)."""
    return R.sorted_distinct(text, RE_F11, 0)


def sdoh_z_codes(text: Column) -> Column:
    """X1d: SDOH Z-codes Z55..Z65 (whole match)."""
    return R.sorted_distinct(text, RE_SDOH_Z, 0)


def weekly_min_services(text: Column) -> Column:
    """First weekly threshold; 1 when the text states none."""
    tok = R.first_group(text, RE_WEEKLY_THRESHOLD, 1, ignore_case=True)
    return F.when(tok.isNull(), F.lit(WEEKLY_DEFAULT).cast("bigint")).otherwise(word_or_int(tok))


def iop_threshold(text: Column) -> Column:
    """Services required after G0137 (lazy gap up to 400 chars); null if absent."""
    return word_or_int(R.first_group(text, RE_IOP_G0137, 1, ignore_case=True))


def iop_window(text: Column) -> Column:
    """7 when the IOP pattern matched, else null."""
    return F.when(R.search(text, RE_IOP_G0137, ignore_case=True), F.lit(IOP_WINDOW_DAYS))


def mentions_take_home(text: Column) -> Column:
    """X4."""
    return R.search(text, RE_TAKEHOME, ignore_case=True)


# Each flag pattern can only match where all of its "required" substrings
# occur (in every alternative); a lower-cased substring test skips the regex
# scan for most documents. ``lower(text)`` is shared by the flags through
# subexpression elimination.
def hf_flag(text: Column) -> Column:
    """X5."""
    return F.lower(text).contains("hf") & R.search(text, RE_HF, ignore_case=True)


def pos58_flag(text: Column) -> Column:
    """X5."""
    return F.coalesce(text.contains("58"), F.lit(False)) & R.search(text, RE_POS_58, ignore_case=True)


def hd_hg_flag(text: Column) -> Column:
    """HD and HG in either order, across lines."""
    low = F.lower(text)
    return low.contains("hd") & low.contains("hg") & R.search(text, RE_HD_HG, ignore_case=True, dotall=True)


def counseling_minutes(text: Column) -> Column:
    """Sorted distinct minute values (1-3 digits) before counseling words."""
    hits = R.find_all(text, RE_COUNSELING_TIME, 1, ignore_case=True)
    return F.array_sort(F.array_distinct(F.transform(hits, lambda m: m.try_cast("int"))))


def min_counseling(text: Column) -> Column:
    """Smallest value or null when none."""
    return F.array_min(counseling_minutes(text))


def requires_dx(f11: Column, h_codes: Column) -> Column:
    """Both lists non-empty."""
    return (F.size(f11) > 0) & (F.size(h_codes) > 0)


def strip_template(text: Column) -> Column:
    """Drop the cover-page placeholder (lazy up to the first ']'), then left-trim."""
    return R.py_lstrip(F.regexp_replace(text, R.pattern(RE_TEMPLATE_PLACEHOLDER, ignore_case=True), ""))


def polysubstance_hits(text: Column, limit: int | None = None) -> Column:
    """Matches, order, case and duplicates kept; ``limit`` keeps the first so many."""
    hits = R.find_all(text, RE_POLYSUBSTANCE, 1, ignore_case=True)
    return hits if limit is None else F.slice(hits, 1, limit)


def excerpt(text: Column, chars: int = EXCERPT_CHARS) -> Column:
    """X11: first ``chars`` code points."""
    return F.substring(text, 1, chars)


def clean_ecfr(text: Column) -> Column:
    """The 'thnsp;' artifact becomes a space."""
    return F.replace(text, F.lit(ECFR_ARTIFACT), F.lit(" "))


# --------------------------------------------------------- extractor jobs
# Each returns the input's key columns plus the source's typed facts.
def extract_cms_ch17(df: DataFrame, text: str = "text") -> DataFrame:
    """E2 (cms_pub_100_02_ch17)."""
    t = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        iop_threshold(t).alias("iop_threshold_services"),
        iop_window(t).alias("iop_window_days"),
        cms_g_codes(t).alias("g_codes_mentioned"),
        excerpt(t).alias("raw_excerpt"),
    )


def extract_cms_ch39(df: DataFrame, text: str = "text") -> DataFrame:
    """E3 (cms_pub_100_04_ch39 and any other manual key)."""
    t = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        weekly_min_services(t).alias("weekly_bundle_min_services"),
        cms_g_codes(t).alias("g_codes_mentioned"),
        excerpt(t).alias("raw_excerpt"),
    )


def extract_mln_booklet(df: DataFrame, text: str = "text") -> DataFrame:
    """E4 (cms_mln_otp_booklet); feeds no rule."""
    t = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        cms_g_codes(t).alias("g_codes_mentioned"),
        mentions_take_home(t).alias("mentions_take_home"),
        excerpt(t).alias("raw_excerpt"),
    )


def extract_tip63(df: DataFrame, text: str = "text", limit: int | None = None) -> DataFrame:
    """E10 (samhsa_tip_63); ``limit`` keeps the first so many hits."""
    t = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        polysubstance_hits(t, limit).alias("polysubstance_hits"),
        excerpt(t).alias("raw_excerpt"),
        t.alias("full_text"),
    )


def extract_cdc_zcodes(df: DataFrame, text: str = "text") -> DataFrame:
    """E11 (cdc_icd10_z_codes)."""
    t = F.col(text)
    z = sdoh_z_codes(t)
    return df.select(
        *[c for c in df.columns if c != text],
        z.alias("sdoh_z_codes_found"),
        F.size(z).alias("z_code_count"),
        excerpt(t).alias("raw_excerpt"),
        t.alias("full_text"),
    )


def extract_sunshine(df: DataFrame, text: str = "text") -> DataFrame:
    """E12 (sunshine_provider_manual): template stripped first."""
    t = strip_template(F.col(text))
    base = df.select(*[c for c in df.columns if c != text], t.alias("_t"))
    f11, h = f11_codes(F.col("_t")), any_h_codes(F.col("_t"))
    return base.select(
        *[c for c in df.columns if c != text],
        f11.alias("f11_dx_codes_referenced"),
        h.alias("h_codes_referenced"),
        requires_dx(f11, h).alias("requires_dx_with_h_codes"),
        excerpt(F.col("_t")).alias("raw_excerpt"),
        F.col("_t").alias("full_text"),
    )


def extract_simply(df: DataFrame, text: str = "text") -> DataFrame:
    """E13 (simply_provider_resources): template stripped first."""
    t = strip_template(F.col(text))
    base = df.select(*[c for c in df.columns if c != text], t.alias("_t"))
    mins = counseling_minutes(F.col("_t"))
    return base.select(
        *[c for c in df.columns if c != text],
        mins.alias("counseling_time_thresholds_minutes"),
        F.array_min(mins).alias("min_counseling_threshold_minutes"),
        excerpt(F.col("_t")).alias("raw_excerpt"),
        F.col("_t").alias("full_text"),
    )


def handbook_facts(df: DataFrame, text: str = "text") -> DataFrame:
    """E5 per handbook: flags, H-codes, 1500-char excerpt, char count."""
    t = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        F.length(t).alias("char_count"),
        hf_flag(t).alias("mentions_HF_modifier"),
        pos58_flag(t).alias("mentions_POS_58"),
        hd_hg_flag(t).alias("mentions_HD_HG_pair"),
        any_h_codes(t).alias("h_codes_referenced"),
        excerpt(t, HANDBOOK_EXCERPT_CHARS).alias("excerpt"),
    )


def handbook_rollup(handbooks: DataFrame, key: str = "source_key", extra: list[Column] | None = None) -> DataFrame:
    """Any-flag rollup and handbook count per source (partial aggregation,
    one shuffle on the source key; a hot source is pre-aggregated map-side).
    ``extra`` aggregates ride along in the same pass."""
    return handbooks.groupBy(key).agg(
        F.count(F.lit(1)).alias("handbook_count"),
        F.coalesce(F.bool_or("mentions_HF_modifier"), F.lit(False)).alias("any_HF_mentioned"),
        F.coalesce(F.bool_or("mentions_POS_58"), F.lit(False)).alias("any_POS_58_mentioned"),
        F.coalesce(F.bool_or("mentions_HD_HG_pair"), F.lit(False)).alias("any_HD_HG_pair_mentioned"),
        *(extra or []),
    )


# Extractor job per source key (E rows of the registry).
EXTRACTOR_JOBS = {
    "cms_pub_100_02_ch17": extract_cms_ch17,
    "cms_pub_100_04_ch39": extract_cms_ch39,
    "cms_mln_otp_booklet": extract_mln_booklet,
    "samhsa_tip_63": extract_tip63,
    "cdc_icd10_z_codes": extract_cdc_zcodes,
    "sunshine_provider_manual": extract_sunshine,
    "simply_provider_resources": extract_simply,
}


def extract_facts(docs: DataFrame, text: str = "text", key: str = "source_key", *, every_source: bool = False) -> DataFrame:
    """All single-document extractors in one pass over a mixed results table.

    Every fact column is ``CASE WHEN source_key IN (...) THEN expr END``, so a
    row only pays for its own source's regexes and the table is scanned once.
    ``every_source`` adds the FCSO page's codes and texts, the handbook's flags
    (``handbook_rollup`` sums them up) and, where the input has ``sections``,
    the eCFR section count. The NCCI sources' facts are tables: operators.ncci.
    """
    k = F.col(key)
    fcso, handbook = (k == "fl_mac_fcso_otp", k == "fl_ahca_cbh_handbook") if every_source else (F.lit(False), F.lit(False))
    raw = F.col(text)
    stripped = strip_template(raw)
    mco = k.isin("sunshine_provider_manual", "simply_provider_resources")
    t = F.when(mco, stripped).otherwise(raw)
    cms = ["cms_pub_100_02_ch17", "cms_pub_100_04_ch39", "cms_mln_otp_booklet"]
    is_ch17 = k == "cms_pub_100_02_ch17"
    is_ch39 = k == "cms_pub_100_04_ch39"
    sun = k == "sunshine_provider_manual"
    f11, h = f11_codes(t), any_h_codes(t)
    z = sdoh_z_codes(t)
    mins = counseling_minutes(t)
    excerpt_keys = cms + list(EXTRACTOR_JOBS)
    full_keys = ["samhsa_tip_63", "cdc_icd10_z_codes", "sunshine_provider_manual", "simply_provider_resources"]
    return docs.select(
        *[c for c in docs.columns if c != text],
        F.when(is_ch39, weekly_min_services(t)).alias("weekly_bundle_min_services"),
        F.when(is_ch17, iop_threshold(t)).alias("iop_threshold_services"),
        F.when(is_ch17, iop_window(t)).alias("iop_window_days"),
        F.when(k.isin(cms), cms_g_codes(t)).when(fcso, any_g_codes(t)).alias("g_codes_mentioned"),
        F.when(k == "cms_mln_otp_booklet", mentions_take_home(t)).alias("mentions_take_home"),
        F.when(k == "samhsa_tip_63", polysubstance_hits(t)).alias("polysubstance_hits"),
        F.when(k == "cdc_icd10_z_codes", z).alias("sdoh_z_codes_found"),
        F.when(k == "cdc_icd10_z_codes", F.size(z)).alias("z_code_count"),
        F.when(sun, f11).alias("f11_dx_codes_referenced"),
        F.when(sun | handbook, h).alias("h_codes_referenced"),
        F.when(sun, requires_dx(f11, h)).alias("requires_dx_with_h_codes"),
        F.when(k == "simply_provider_resources", mins).alias("counseling_time_thresholds_minutes"),
        F.when(k == "simply_provider_resources", F.array_min(mins)).alias("min_counseling_threshold_minutes"),
        F.when(k.isin(excerpt_keys) | fcso, excerpt(t)).when(handbook, excerpt(t, HANDBOOK_EXCERPT_CHARS)).alias("raw_excerpt"),
        F.when(k.isin(full_keys) | fcso | handbook, t).alias("full_text"),
        *(
            [
                F.when(handbook, F.length(t)).alias("char_count"),
                F.when(handbook, hf_flag(t)).alias("mentions_HF_modifier"),
                F.when(handbook, pos58_flag(t)).alias("mentions_POS_58"),
                F.when(handbook, hd_hg_flag(t)).alias("mentions_HD_HG_pair"),
            ]
            if every_source
            else []
        ),
        *([F.when((k == "ecfr_42_part_8") & F.col("sections").isNotNull(), F.size("sections")).alias("section_count")] if every_source and "sections" in docs.columns else []),
    )


# The 'doc' label each extractor stamps on its facts.
DOC_LABELS = {
    "cms_pub_100_02_ch17": "Pub 100-02 Ch 17",
    "cms_pub_100_04_ch39": "Pub 100-04 Ch 39",
    "cms_mln_otp_booklet": "MLN OTP Booklet",
    "fl_ahca_cbh_handbook": "FL AHCA Community Behavioral Health",
    "fl_mac_fcso_otp": "FCSO OTP Specialty Page (HTML)",
    "cms_ncci_edits": "NCCI PTP Edits (practitioner, FULL table)",
    "cms_ncci_medicaid": "Medicaid NCCI PTP Edits (practitioner)",
    "ecfr_42_part_8": "42 CFR Part 8",
    "samhsa_tip_63": "SAMHSA TIP 63",
    "cdc_icd10_z_codes": "CDC ICD-10-CM Guidelines",
    "sunshine_provider_manual": "Sunshine Health Provider Manual",
    "simply_provider_resources": "Simply Healthcare Provider Manual",
}
NCCI_DELTA_DOC = "NCCI PTP Edits (practitioner, DELTA fallback)"
NCCI_NO_LINK_DOC = "NCCI"
MEDICAID_NO_LINK_DOC = "Medicaid NCCI PTP Edits"


def doc_label(source_key: Column) -> Column:
    out = None
    for k, v in DOC_LABELS.items():
        out = F.when(source_key == k, F.lit(v)) if out is None else out.when(source_key == k, F.lit(v))
    return out.otherwise(F.lit(""))
