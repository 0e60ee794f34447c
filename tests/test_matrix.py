"""Rule matrix: which facts give which rules, in which order, with which values."""
import json
import re

import pytest

from regloom.operators import matrix as M
from regloom.operators import templates as T
from regloom.operators.coverage import status_totals

BASE = "result_ord bigint, source_key string, source_name string, fetched_at string, content_sha256 string, warnings array<string>, parsed_empty boolean"
EDITS = "source_key string, result_ord bigint, edit_ord bigint, column1 string, column2 string"


def scraped(spark, *rows, facts=""):
    """rows: (source key, fact values...[, warnings as the last when a list of str is given by name])."""
    names = [f.split()[0] for f in facts.split(", ")] if facts else []
    data = []
    for i, (key, values, *rest) in enumerate(rows):
        warnings, empty = (rest + [[], False])[:2] if rest else ([], False)
        data.append((i, key, f"name of {key}", "2030-01-01T00:00:00Z", f"{i:064x}", warnings, empty, *[values.get(n) for n in names]))
    return spark.createDataFrame(data, BASE + (", " + facts if facts else ""))


def rules(df, edits=None):
    return [r.asDict() for r in M.build_rules(df, edits).orderBy("rule_ord").collect()]


def params(rule):
    return json.loads(rule["params_json"])


#: Rules of each source when nothing but the source itself is known.
BY_SOURCE = {
    "cms_pub_100_04_ch39": ["R-FED-01"],
    "cms_pub_100_02_ch17": [],
    "cms_mln_otp_booklet": [],
    "ecfr_42_part_8": ["R-FED-03", "R-FED-04", "R-FED-05", "R-FED-06"],
    "fl_ahca_cbh_handbook": ["R-FL-02", "R-FL-03", "R-FL-04", "R-FL-05"],
    "fl_mac_fcso_otp": ["R-FLMAC-01"],
    "sunshine_provider_manual": [],
    "simply_provider_resources": ["R-SIMPLY-01"],
    "fl_dcf_fasams": ["R-FASAMS-01", "R-FASAMS-02"],
    "fl_mso_contracts": ["R-MSO-01"],
    "fl_eforcse_pdmp": ["R-PDMP-01"],
    "fl_65d30_fac": ["R-CRED-01", "R-TPLAN-01"],
    "internal_policy": [],
    "fl_ahca_carf_ai_consent": [],
    "not_in_the_catalog": [],
}


def test_rules_by_source_federal_first_then_in_result_order(spark):
    keys = list(BY_SOURCE)[::-1]
    out = rules(scraped(spark, *[(k, {}) for k in keys]))
    federal = [k for k in keys if k in T.FEDERAL_KEYS]
    rest = [k for k in keys if k not in T.FEDERAL_KEYS]
    assert [r["rule_id"] for r in out] == [i for k in federal + rest for i in BY_SOURCE[k]]
    assert [r["rule_ord"] for r in out] == list(range(len(out)))
    assert all(r["friendly_message"] and "%s" not in r["friendly_message"] for r in out)


def test_every_basis_has_a_maturity(spark):
    for r in rules(scraped(spark, *[(k, {}) for k in BY_SOURCE])):
        p = json.loads(r["params_json"] or "{}")
        assert ("regulatory_basis" in p) == ("maturity" in p)
        assert p.get("maturity") in (None, "established", "evolving", "contract")


def test_matrix_rule_numbers(spark):
    numbers = {r["rule_id"]: json.loads(r["params_json"] or "{}").get("matrix_rule_number") for r in rules(scraped(spark, *[(k, {}) for k in BY_SOURCE]))}
    want = {"R-FL-05": 4, "R-FASAMS-01": 28, "R-FASAMS-02": 29, "R-MSO-01": 30, "R-PDMP-01": 35, "R-CRED-01": 36, "R-TPLAN-01": 37}
    assert {i: n for i, n in numbers.items() if i in want} == want


@pytest.mark.parametrize(
    ("key", "fact", "value", "rule", "shown", "param"),
    [
        ("cms_pub_100_04_ch39", "weekly_bundle_min_services bigint", 3, "R-FED-01", "3", ("min_services_in_bundle", 3)),
        ("cms_pub_100_04_ch39", "weekly_bundle_min_services bigint", None, "R-FED-01", "1", ("min_services_in_bundle", 1)),
        ("cms_pub_100_02_ch17", "iop_threshold_services bigint", 12, "R-FED-02", "12", ("required_services", 12)),
        ("cms_pub_100_02_ch17", "iop_threshold_services bigint", 0, None, None, None),
        ("cms_pub_100_02_ch17", "iop_threshold_services bigint", None, None, None, None),
        ("simply_provider_resources", "min_counseling_threshold_minutes int", 40, "R-SIMPLY-01", "40", ("min_minutes", 40)),
        ("simply_provider_resources", "min_counseling_threshold_minutes int", 0, "R-SIMPLY-01", "15", ("min_minutes", 15)),
    ],
)
def test_facts_reach_message_and_params(spark, key, fact, value, rule, shown, param):
    out = rules(scraped(spark, (key, {fact.split()[0]: value}), facts=fact))
    assert [r["rule_id"] for r in out] == ([rule] if rule else [])
    if rule:
        assert re.search(rf"\b{shown}\b", out[0]["friendly_message"]) and params(out[0])[param[0]] == param[1]


def test_lists_in_params(spark):
    codes = [f"G{i}" for i in range(2067, 2080)]
    out = rules(scraped(spark, ("fl_mac_fcso_otp", {"g_codes_mentioned": codes}), facts="g_codes_mentioned array<string>"))
    assert params(out[0]) == {"enforce_g_codes": codes, "block_standard_hcpcs": True}
    facts = "requires_dx_with_h_codes boolean, h_codes_referenced array<string>"
    many = [f"H{i:04d}" for i in range(40)]
    for flag, count in ((True, 1), (False, 0), (None, 0)):
        out = rules(scraped(spark, ("sunshine_provider_manual", {"requires_dx_with_h_codes": flag, "h_codes_referenced": many}), facts=facts))
        assert len(out) == count
    assert params(rules(scraped(spark, ("sunshine_provider_manual", {"requires_dx_with_h_codes": True, "h_codes_referenced": many[:2]}), facts=facts))[0])["h_codes_in_scope"] == many[:2]


def test_take_home_caps(spark):
    gate = next(r for r in rules(scraped(spark, ("ecfr_42_part_8", {}))) if r["logic_type"] == "TakeHomeStabilityGate")
    p = params(gate)
    assert (gate["rule_id"], p["initial_window_days"], p["initial_cap_days"], list(p["cap_schedule_days"].values())) == ("R-FED-05", 14, 7, [7, 14, 28])


@pytest.mark.parametrize(("warnings", "empty", "left"), [(["scrape_failed: timeout"], False, 0), (["late", "x scrape_failed y"], False, 0), (["slow"], False, 1), (None, False, 1), ([], True, 0)])
def test_failed_or_empty_results_give_no_rules(spark, warnings, empty, left):
    assert len(rules(scraped(spark, ("fl_mso_contracts", {}, warnings, empty)))) == left


def test_pair_rules_are_numbered_per_table(spark):
    df = scraped(spark, ("cms_ncci_medicaid", {}), ("cms_ncci_edits", {}), ("fl_mso_contracts", {}))
    edits = spark.createDataFrame(
        [("cms_ncci_medicaid", 0, n, f"A{n:04d}", "B0000") for n in (1, 0)] + [("cms_ncci_edits", 1, n, f"C{n}", "D0000") for n in (10000, 9999)] + [("fl_mso_contracts", 2, 0, "X", "Y")], EDITS
    )
    out = rules(df, edits)
    assert [(r["rule_id"], r["code"]) for r in out if "NCCI" in r["rule_id"]] == [
        ("R-NCCIMCD-0000", out[0]["code"]), ("R-NCCIMCD-0001", out[1]["code"]), ("R-NCCI-9999", out[2]["code"]), ("R-NCCI-10000", out[3]["code"]),
    ]
    assert "A0001 cannot be billed on the same day as B0000" in out[1]["friendly_message"]
    assert out[-1]["rule_id"] == "R-MSO-01"


def test_message_check_rejects_blank(spark):
    for text in (" ", "", None):
        with pytest.raises(Exception):
            M.check_messages(spark.createDataFrame([("R-1", text)], "rule_id string, friendly_message string")).collect()


def test_header_counts_and_provenance_lists_builders(spark):
    df = scraped(spark, ("fl_65d30_fac", {}), ("cms_mln_otp_booklet", {}), ("cms_pub_100_02_ch17", {}), ("fl_mso_contracts", {}, ["scrape_failed"], False))
    head = M.header(M.build_rules(df)).first()
    assert (head.schema_version, head.rule_count) == (T.RULE_SCHEMA_VERSION, 2)
    listed = [r.source_key for r in M.provenance(df).orderBy("result_ord").collect()]
    assert "cms_pub_100_02_ch17" in listed and "cms_mln_otp_booklet" not in listed and listed[0] == "fl_65d30_fac"


def test_unnumbered_build_has_the_same_rules(spark):
    df = scraped(spark, *[(k, {}) for k in BY_SOURCE])
    bare = {tuple(r) for r in M.build_rules(df, numbered=False).collect()}
    assert bare == {tuple(r) for r in M.build_rules(df).drop("rule_ord").collect()} and len(bare) == sum(map(len, BY_SOURCE.values()))


def test_coverage_status_totals(spark):
    assert {r.status: r.n for r in status_totals(spark).collect()} == {"live": 8, "defined": 6, "deferred": 2}


def test_all_h_codes_unless_bounded(spark):
    many = [f"H{i:04d}" for i in range(40)]
    df = scraped(spark, ("sunshine_provider_manual", {"requires_dx_with_h_codes": True, "h_codes_referenced": many}), facts="requires_dx_with_h_codes boolean, h_codes_referenced array<string>")
    assert params(rules(df)[0])["h_codes_in_scope"] == many
    assert json.loads(M.build_rules(df, max_h_codes=25).first().params_json)["h_codes_in_scope"] == many[:25]
