"""Composed handbook results and PTP table jobs on hand-made pages and files."""
from pyspark.sql import functions as F

from regloom.operators import handbooks as H
from regloom.operators import links as L
from regloom.operators import markup as MK
from regloom.operators import ncci

NAMES, URLS = zip(*MK.KNOWN_HANDBOOK_PDFS, strict=True)
BASE = "https://site.example/a/index.html"


def results(spark, pages, files):
    parsed = MK.parse_pages(spark.createDataFrame([(i, BASE, h) for i, h in pages.items()], "page_id bigint, url string, html string"))
    given = spark.createDataFrame([(u, t, e) for u, (t, e) in files.items()], "url string, text string, error string")
    return {r.page_id: r for r in H.handbook_results(parsed, given).collect()}


def test_known_ones_first_then_links_in_order(spark):
    html = f'<p><a href="z.pdf">Z</a><a href="{URLS[2]}">known by another name</a><a href="/content/download/5/x">Five</a><a href="a.PDF">A</a><a href="z.pdf">Z again</a><a href="m.pdf">Media kit</a><a href="page.html">no</a></p>'
    files = {u: (f"text of {n}", None) for n, u in MK.KNOWN_HANDBOOK_PDFS} | {
        "https://site.example/a/z.pdf": ("z", None), "https://site.example/content/download/5/x": ("five H0005", None), "https://site.example/a/a.PDF": (None, "HTTP 500"),
    }
    got = results(spark, {1: html, 2: "<p>no links</p>"}, files)
    assert [h.label for h in got[1].handbooks] == [*NAMES, "Z", "Five"] and [h.label for h in got[2].handbooks] == list(NAMES)
    assert (got[1].handbook_count, got[2].handbook_count) == (10, 8)
    assert got[1].warnings == [f"{H.FILE_WARNING}https://site.example/a/a.PDF: HTTP 500"] and got[2].warnings == []
    assert got[1].handbooks[9].h_codes_referenced == ["H0005"] and got[1].handbooks[0].full_text == f"text of {NAMES[0]}"


def test_flags_of_any_handbook(spark):
    got = results(spark, {1: '<a href="x.pdf">X</a>', 2: "<b>none</b>"}, {"https://site.example/a/x.pdf": ("use modifier HF; place of service 58; HG after HD", None), URLS[0]: ("", None)})
    assert [got[1][f"any_{x}_mentioned"] for x in ("HF", "POS_58", "HD_HG_pair")] == [True] * 3
    assert [got[2][f"any_{x}_mentioned"] for x in ("HF", "POS_58", "HD_HG_pair")] == [False] * 3
    assert got[2].handbook_count == 1 and got[2].handbooks[0].char_count == 0 and len(got[2].warnings) == 7


def test_pages_that_could_not_be_read(spark):
    got = results(spark, {1: None, 2: "<![bad[x]]><a href='x.pdf'>x</a>"}, {})
    assert got[1].warnings[0] == f"{H.LANDING_WARNING}{MK.NO_PAGE}" and "marked section" in got[2].warnings[0]
    assert all(len(r.warnings) == 9 and r.handbooks == [] and r.doc == "FL AHCA Community Behavioral Health" for r in got.values())


def jobs(spark, make, links, payloads, rows, pages=()):
    base = "https://c.example/p/"
    hrefs = spark.createDataFrame([(p, base, i, h) for p, hs in links.items() for i, h in enumerate(hs)], "page_id int, base_url string, href_pos int, href string")
    files = spark.createDataFrame([(base + u, *x) for u, x in payloads.items()], "url string, digest string, is_zip boolean")
    unpacked = spark.createDataFrame([(base + u, 0, "x_additions.txt", None, i, c) for u, cs in rows.items() for i, c in enumerate(cs)], "url string, file_ord int, member string, sheet string, row_ord bigint, cells array<string>")
    all_ = spark.createDataFrame([(p,) for p in pages], "page_id int") if pages else None
    return {r.page_id: r for r in make(hrefs, files, unpacked, all_).results.collect()}


DELTA, FULL, ZIP = "practitioner-additions.zip", "medicare-ncci-2025q1-practitioner-ptp-edits-ccipra-v1r0-f{}.zip", "medicaid-2025-q2-practitioner-ptp.zip"


def test_files_that_are_no_zip(spark):
    edit = ["H0020", "80305", "1"]
    got = jobs(
        spark, ncci.medicare_tables, {1: [FULL.format(1), FULL.format(2), FULL.format(3)], 2: [DELTA], 3: ["x.html"]},
        {FULL.format(1): ("d1", True), FULL.format(2): ("d2", False)}, {FULL.format(1): [edit], FULL.format(2): [["G2067", "99213", "0"]]}, pages=[1, 2, 3, 4],
    )
    assert got[1].edit_count_relevant == 1 and got[1].part_count == 3
    assert got[1].warnings == [f"{ncci.NOT_A_ZIP}https://c.example/p/{FULL.format(2)}", f"Skipped part{ncci.NOT_FETCHED}https://c.example/p/{FULL.format(3)}"]
    # The only file of a page: its failure is the result's.
    assert (got[2].table_scope, got[2].source_zips, got[2].content_sha256) == (None, [], "") and got[2].warnings[0].startswith("scrape_failed: ")
    assert [(got[p].table_scope, got[p].warnings) for p in (3, 4)] == [("none", [L.NO_LINK_WARNING])] * 2


def test_medicaid_pages_without_any_link(spark):
    got = jobs(spark, ncci.medicaid_tables, {1: [ZIP], 2: ["x.html"]}, {ZIP: ("m", True)}, {ZIP: [["H0020", "80305", "1"]]}, pages=[1, 2, 3])
    assert {p: (r.table_scope, r.edit_count_relevant) for p, r in got.items()} == {1: ("medicaid_ptp", 1), 2: ("none", 0), 3: ("none", 0)}


def test_one_file_on_many_pages_is_filtered_once(spark):
    links = {p: [FULL.format(1)] for p in range(30)}
    rows = {FULL.format(1): [["H0020", f"{10000 + i % 50}", "1"] for i in range(500)] + [["99213", "99214", "1"]] * 100}
    got = jobs(spark, ncci.medicare_tables, links, {FULL.format(1): ("d", True)}, rows)
    assert {r.edit_count_relevant for r in got.values()} == {50} and len(got) == 30
    found = ncci.file_edits(spark.createDataFrame([("u", 0, "a_additions.txt", None, i, ["H0020", "80305", str(i)]) for i in (9, 1, 0)], "url string, file_ord int, member string, sheet string, row_ord bigint, cells array<string>"))
    assert [(r.row_ord, r.modifier_indicator) for r in found.collect()] == [(0, "0")]
    assert found.select(F.count(F.lit(1))).first()[0] == 1
