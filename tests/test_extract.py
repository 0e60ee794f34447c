"""Extractor semantics against Python's re on hand-made texts."""
import re

from pyspark.sql import functions as F

from regloom.operators import extract as X

TEXTS = [
    "G0137 requires a minimum of nine distinct services.",
    "G0137 ... twentynine services here",
    "Bill G2067, G2078 and G2067; at least 2 services per 7-day period. G2060 too.",
    "At Least TWELVE services every 7 day window",
    "minimum of 3 service in a 7 day",
    "a 15 minutes counseling visit; 20 min session; 1500 min therapy; 45 minute counselling",
    "a 15\u00a0minute counseling",
    "Z59.01 and Z55.0x, Z66.1, Z65.9 with polysubstance and Alcohol  use; drank alcohol",
    "H0020 and H2010 need F11.20 or F11.2X; H00201 no",
    "modifier HF applies at POS-58; use HD\nbefore HG",
    "take-home dose; unsupervised medication",
    "[ Grab your reader's attention with a great quote ]   Body",
    "eCFR thnsp;heading",
    "",
]

_WORDS = {w: i for i, w in enumerate(X.NUMBER_WORDS, 1)}


def to_int(tok):
    tok = tok.strip().lower()
    return _WORDS[tok] if tok in _WORDS else int(tok)


def py_facts(t):
    iop = re.search(X.RE_IOP_G0137, t, re.I)
    wk = re.search(X.RE_WEEKLY_THRESHOLD, t, re.I)
    mins = [int(m) for m in re.findall(X.RE_COUNSELING_TIME, t, re.I) if m.isdigit()]
    stripped = re.sub(X.RE_TEMPLATE_PLACEHOLDER, "", t, flags=re.I).lstrip()
    return {
        "iop": to_int(iop.group(1)) if iop else None,
        "weekly": to_int(wk.group(1)) if wk else 1,
        "g": sorted(set(re.findall(X.RE_G_CODE_CMS, t))),
        "gany": sorted(set(re.findall(X.RE_G_CODE_ANY, t))),
        "h": sorted(set(re.findall(X.RE_H_CODE, t))),
        "f11": sorted(set(re.findall(X.RE_F11, t))),
        "z": sorted(set(re.findall(X.RE_SDOH_Z, t))),
        "mins": sorted(set(mins)),
        "poly": re.findall(X.RE_POLYSUBSTANCE, t, re.I)[:50],
        "takehome": bool(re.search(X.RE_TAKEHOME, t, re.I)),
        "hf": bool(re.search(X.RE_HF, t, re.I)),
        "pos": bool(re.search(X.RE_POS_58, t, re.I)),
        "hdhg": bool(re.search(X.RE_HD_HG, t, re.I | re.S)),
        "strip": stripped,
        "ecfr": t.replace("thnsp;", " "),
    }


def test_extractors_match_python_re(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    t = F.col("t")
    out = df.select(
        "i",
        X.iop_threshold(t).alias("iop"),
        X.weekly_min_services(t).alias("weekly"),
        X.cms_g_codes(t).alias("g"),
        X.any_g_codes(t).alias("gany"),
        X.any_h_codes(t).alias("h"),
        X.f11_codes(t).alias("f11"),
        X.sdoh_z_codes(t).alias("z"),
        X.counseling_minutes(t).alias("mins"),
        X.polysubstance_hits(t).alias("poly"),
        X.mentions_take_home(t).alias("takehome"),
        X.hf_flag(t).alias("hf"),
        X.pos58_flag(t).alias("pos"),
        X.hd_hg_flag(t).alias("hdhg"),
        X.strip_template(t).alias("strip"),
        X.clean_ecfr(t).alias("ecfr"),
    ).orderBy("i")
    for row in out.collect():
        got = row.asDict()
        exp = py_facts(TEXTS[got.pop("i")])
        assert got == exp, TEXTS[row.i]


def test_known_quirks(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select(X.iop_threshold(F.col("t")).alias("iop"), X.counseling_minutes(F.col("t")).alias("m")).collect()
    assert rows[1].iop == 9  # no left boundary on the number word: "twentynine" gives nine
    assert rows[5].m == [20, 45, 500]  # plural "minutes" is rejected; "1500 min" gives 500
    assert rows[6].m == [15]  # a non-breaking space is whitespace, as in Python


def test_extract_facts_single_pass(spark):
    rows = [(0, "cms_pub_100_02_ch17", TEXTS[0]), (1, "cms_pub_100_04_ch39", TEXTS[2]), (2, "simply_provider_resources", TEXTS[5]),
            (3, "sunshine_provider_manual", TEXTS[8]), (4, "cdc_icd10_z_codes", TEXTS[7]), (5, "unknown", TEXTS[0])]
    df = spark.createDataFrame(rows, "result_ord int, source_key string, text string")
    f = {r.result_ord: r for r in X.extract_facts(df).collect()}
    assert f[0].iop_threshold_services == 9 and f[0].iop_window_days == 7 and f[0].weekly_bundle_min_services is None
    assert f[1].weekly_bundle_min_services == 2 and f[1].g_codes_mentioned == ["G2060", "G2067", "G2078"]
    assert f[2].min_counseling_threshold_minutes == 20
    assert f[3].requires_dx_with_h_codes is True and f[3].h_codes_referenced == ["H0020", "H2010"]
    assert f[4].z_code_count == 3  # Z66.1 is outside Z55-Z65
    assert f[5].raw_excerpt is None and f[5].g_codes_mentioned is None


def test_facts_of_every_source(spark):
    from regloom.plans.run import with_facts

    rows = [(0, "fl_mac_fcso_otp", "G2067 and G2215"), (1, "fl_ahca_cbh_handbook", "H0020 with modifier HF at POS 58"), (2, "ecfr_42_part_8", "x")]
    df = spark.createDataFrame([(*r, []) for r in rows], "result_ord int, source_key string, text string, warnings array<string>")
    facts = with_facts(df)
    f = {r.result_ord: r for r in facts.collect()}
    assert f[0].g_codes_mentioned == ["G2067", "G2215"] and f[0].full_text == rows[0][2]
    assert f[1].mentions_HF_modifier and f[1].mentions_POS_58 and not f[1].mentions_HD_HG_pair and f[1].h_codes_referenced == ["H0020"]
    assert f[0].mentions_HF_modifier is None and "section_count" in facts.columns


def test_handbook_rollup(spark):
    rows = [("a", "modifier HF at POS 58"), ("a", "nothing"), ("b", "HG then HD")]
    hb = X.handbook_facts(spark.createDataFrame(rows, "source_key string, text string"))
    got = {r.source_key: r for r in X.handbook_rollup(hb).collect()}
    assert got["a"].handbook_count == 2 and got["a"].any_HF_mentioned and got["a"].any_POS_58_mentioned
    assert not got["a"].any_HD_HG_pair_mentioned and got["b"].any_HD_HG_pair_mentioned
