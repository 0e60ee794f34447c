"""End-to-end run with diff-gated promotion, and the streaming chunker."""
import os

from pyspark.sql import functions as F

from regloom.plans.run import run
from regloom.streaming import chunk_stream

LANDED = "source_key string, fetched_at string, content_sha256 string, raw_path string, text string, warnings array<string>, sections array<struct<id:string,label:string,text:string>>"


def landed(spark, weekly="2"):
    para = "Paragraph one about methadone.\n\nParagraph two " + "x" * 1500
    rows = [
        ("cms_pub_100_04_ch39", "t", "a" * 64, "", f"Bill G2067 with at least {weekly} services per 7-day period.", [], None),
        ("cms_pub_100_02_ch17", "t", "b" * 64, "", "G0137 requires a minimum of nine services.", [], None),
        ("fl_ahca_cbh_handbook", "t", "", "", "handbook text", [], None),
        ("fl_mac_fcso_otp", "", "", "", None, ["scrape_failed: 503"], None),
        ("samhsa_tip_63", "t", "c" * 64, "", para, [], None),
        ("cdc_icd10_z_codes", "t", "d" * 64, "", "Z59.01 housing", [], None),
        ("ecfr_42_part_8", "t", "e" * 64, "", "<xml/>", [], [{"id": "8.1", "label": "Scope", "text": "Section body"}]),
        ("asam_criteria", "t", "f" * 64, "", "not registered", [], None),
    ]
    return spark.createDataFrame(rows, LANDED)


def test_run_promote_and_rerun(spark, scratch):
    out = os.path.join(scratch, "out")
    s1 = run(spark, landed(spark), out, "r1", promote=True)
    assert s1.diff_material and s1.promoted
    # R-FED-01 + R-FED-02 + R-FL-02..05 + R-FED-03..06 = 10 rules; the failed FCSO source gives none.
    assert s1.rule_count == 10
    assert s1.chunk_count == 5  # eCFR section 1 + TIP 63 (paragraph 1: 1 window, paragraph 2 of 1514 chars: 2) + CDC 1
    assert s1.new_chunk_count == 5
    s2 = run(spark, landed(spark), out, "r2", promote=True)
    assert not s2.diff_material and not s2.promoted
    assert s2.new_chunk_count == 0  # same texts: nothing to re-embed
    s3 = run(spark, landed(spark, weekly="3"), out, "r3", promote=True)
    assert s3.diff_material and s3.promoted
    diff = spark.read.json(os.path.join(out, "runs", "r3", "diff"))
    paths = sorted(r.path for r in diff.filter(F.col("rule_id") == "R-FED-01").collect())
    assert paths == ["root['friendly_message']", "root['params']['min_services_in_bundle']"]
    # Results of every run are kept (run-partitioned).
    runs = sorted(r.run_id for r in spark.read.parquet(os.path.join(out, "results")).select("run_id").distinct().collect())
    assert runs == ["r1", "r2", "r3"]


def test_run_only_and_engine1(spark, scratch):
    out = os.path.join(scratch, "out2")
    s = run(spark, landed(spark), out, "r1", only=["cms_pub_100_02_ch17", "samhsa_tip_63", "nope"], engine1_only=True)
    assert s.rule_count == 1 and s.chunk_count == 3


def test_streaming_adds_only_new_chunks(spark, scratch):
    src = os.path.join(scratch, "landing")
    sink = os.path.join(scratch, "chunks")
    ckpt = os.path.join(scratch, "ckpt")
    schema = "doc_id bigint, source_key string, label string, text string"
    spark.createDataFrame([(1, "s", "l", "alpha"), (2, "s", "l", "beta\n\ngamma")], schema).write.parquet(os.path.join(src, "b1"))
    chunk_stream.run_available(spark, src, sink, ckpt, schema=schema)
    first = spark.read.parquet(sink).count()
    assert first == 3
    spark.createDataFrame([(3, "s", "l", "alpha"), (4, "s", "l", "delta")], schema).write.parquet(os.path.join(src, "b2"))
    chunk_stream.run_available(spark, src, sink, ckpt, schema=schema)
    df = spark.read.parquet(sink)
    assert df.count() == 4  # 'alpha' was known; only 'delta' is new
    assert sorted(r.text for r in df.collect()) == ["alpha", "beta", "delta", "gamma"]


def test_known_ids_are_state_and_the_sink_is_never_read(spark, scratch):
    """Two runs with a restart between; what the first one stored is gone by then."""
    src, sink, ckpt = (os.path.join(scratch, x) for x in ("landing", "sink", "ckpt"))

    def stored():
        files = [os.path.join(sink, f) for f in os.listdir(sink) if f.endswith(".parquet")]
        rows = [(r.source_key, r.text) for f in files for r in spark.read.parquet(f).collect()]
        for f in files:
            os.remove(f)
        return sorted(rows)

    spark.createDataFrame([(1, "s", "l", "alpha\n\nbeta\n\nalpha")], chunk_stream.TEXT_SCHEMA).write.parquet(os.path.join(src, "b1"))
    chunk_stream.run_available(spark, src, sink, ckpt)
    assert stored() == [("s", "alpha"), ("s", "beta")]
    spark.createDataFrame([(2, "s", "l", "beta\n\ngamma"), (3, "other", "l", "alpha")], chunk_stream.TEXT_SCHEMA).write.parquet(os.path.join(src, "b2"))
    chunk_stream.run_available(spark, src, sink, ckpt)
    assert stored() == [("other", "alpha"), ("s", "gamma")]
    chunk_stream.run_available(spark, src, sink, ckpt)
    assert stored() == []


def test_a_batch_that_failed_is_repeated_whole(spark, scratch):
    """The state of a batch whose commit is lost is thrown away with it."""
    src, sink, ckpt = (os.path.join(scratch, x) for x in ("landing", "sink", "ckpt"))
    for i, text in enumerate(["alpha", "alpha\n\nomega"]):
        spark.createDataFrame([(i, "s", "l", text)], chunk_stream.TEXT_SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    chunk_stream.run_available(spark, src, sink, ckpt, max_files_per_trigger=1)
    os.remove(os.path.join(ckpt, "commits", "1"))
    os.path.exists(os.path.join(ckpt, "commits", ".1.crc")) and os.remove(os.path.join(ckpt, "commits", ".1.crc"))
    chunk_stream.run_available(spark, src, sink, ckpt, max_files_per_trigger=1)
    assert sorted(r.text for r in spark.read.parquet(sink).collect()) == ["alpha", "omega"]


def test_run_from_landed_files(spark, scratch):
    import hashlib

    from regloom.sources.landed import landed_documents

    root = os.path.join(scratch, "raw")

    def land(key, suffix, body):
        d = os.path.join(root, key)
        os.makedirs(d, exist_ok=True)
        data = body.encode("utf-8")
        open(os.path.join(d, hashlib.sha256(data).hexdigest()[:12] + suffix), "wb").write(data)

    land("cms_pub_100_02_ch17", ".txt", "G0137 requires a minimum of nine services. G2067")
    land("fl_mac_fcso_otp", ".html", "<html><nav>G9999</nav><article>Bill G2067 <a href='/a.pdf'>a</a></article></html>")
    land("ecfr_42_part_8", ".xml", '<ECFR><DIV8 TYPE="SECTION" N="8.1"><HEAD>Scope</HEAD><P>Body</P></DIV8></ECFR>')
    land("samhsa_tip_63", ".txt", "Polysubstance use.\n\nSecond paragraph.")
    docs = landed_documents(spark, root)
    got = {r.source_key: r for r in docs.collect()}
    assert got["fl_mac_fcso_otp"].text == "Bill G2067 a"
    assert got["ecfr_42_part_8"].sections[0].id == "8.1" and got["ecfr_42_part_8"].text is None
    s = run(spark, docs, os.path.join(scratch, "out3"), "r1")
    # R-FED-02, R-FLMAC-01, R-FED-03..06; chunks: eCFR 1 + TIP 63 2.
    assert s.rule_count == 6 and s.chunk_count == 3


def test_reports_from_a_run(spark, scratch):
    from regloom.plans.reports import write_reports

    out = os.path.join(scratch, "out4")
    run(spark, landed(spark), out, "r1")
    paths = write_reports(spark, out, "r1")
    summary = spark.read.option("header", True).csv(paths["run_summary"])
    got = {r.source_key: (r.status, r.extracted_unit) for r in summary.collect()}
    assert got["fl_mac_fcso_otp"][0] == "FAIL"
    assert got["ecfr_42_part_8"] == ("OK", "sections")
    assert got["cms_pub_100_04_ch39"] == ("OK", "G-codes mentioned")
    rules = spark.read.option("header", True).csv(paths["rules"])
    assert rules.count() == 10 and rules.filter(F.col("params_json") == "{}").count() == 2
    t = spark.read.option("header", True).csv(paths["totals"]).first()
    assert (t.ok, t.fail, t.rule_count, t.chunk_count) == ("6", "1", "10", "5")
    assert spark.read.json(os.path.join(out, "runs", "r1", "matrix_header")).first().rule_count == 10


def test_landed_reader_takes_newest_file(spark, scratch):
    import time as _t

    from regloom.sources.landed import landed_documents

    d = os.path.join(scratch, "raw2", "samhsa_tip_63")
    os.makedirs(d)
    old = os.path.join(d, "aaaaaaaaaaaa.txt")
    new = os.path.join(d, "bbbbbbbbbbbb.txt")
    open(old, "w").write("old text")
    os.utime(old, (_t.time() - 3600, _t.time() - 3600))
    open(new, "w").write("new text")
    got = landed_documents(spark, os.path.join(scratch, "raw2")).collect()
    assert len(got) == 1 and got[0].text == "new text" and got[0].raw_path.endswith("bbbbbbbbbbbb.txt")


def land(root, *steps, body, age=0):
    path = os.path.join(root, *steps)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body.encode("utf-8"))
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def test_all_handbooks_of_a_landing_page(spark, scratch):
    from urllib.parse import quote

    from regloom.operators import handbooks as H
    from regloom.operators import markup as MK
    from regloom.sources.landed import landed_documents

    root, key = os.path.join(scratch, "raw"), H.SOURCE_KEY
    name, url = MK.KNOWN_HANDBOOK_PDFS[1]
    found, extra = "https://ahca.myflorida.com/content/download/9/file/new%20rule.pdf", "https://ahca.myflorida.com/x/unlisted.pdf"
    land(root, key, "land.html", body=f'<a href="/content/download/9/file/new%20rule.pdf"> New rule </a><a href="{url}">other name</a><a href="/gone.pdf">Gone</a>')
    land(root, key, quote(url, safe=""), "old.txt", body="old text H9999", age=3600)
    land(root, key, quote(url, safe=""), "new.txt", body="Use modifier HF at POS-58. H0020 " + "long " * 800)
    land(root, key, quote(found, safe=""), "a.txt", body="HD before HG")
    land(root, key, quote(extra, safe=""), "b.txt", body="H0001 and H0004")
    land(root, "fl_mac_fcso_otp", "p.html", body="<article>G2067 <a href='/b.pdf'>b</a><a href='a.PDF'>a</a></article><nav><a href='/n.pdf'>n</a></nav>")
    land(root, "samhsa_tip_63", "p.html", body="<![bad[x]]>text that no parser reads")
    out = os.path.join(scratch, "out")
    docs = landed_documents(spark, root)
    assert docs.where(docs.source_key == key).count() == 4
    run(spark, docs, out, "r1")
    results = {r.source_key: r for r in spark.read.parquet(os.path.join(out, "results")).collect()}
    got = results[key]
    assert [(h.label, h.url) for h in got.handbooks] == [(name, url), ("New rule", found), (extra, extra)]
    assert got.handbooks[0].full_text.endswith("long ") and len(got.handbooks[0].full_text) > 4000 and len(got.handbooks[0].excerpt) == 1500
    assert [h.h_codes_referenced for h in got.handbooks] == [["H0020"], [], ["H0001", "H0004"]]
    assert (got.handbook_count, got.any_HF_mentioned, got.any_POS_58_mentioned, got.any_HD_HG_pair_mentioned, got.parsed_empty) == (3, True, True, True, False)
    missing = [u for _, u in MK.KNOWN_HANDBOOK_PDFS if u != url] + ["https://ahca.myflorida.com/gone.pdf"]
    assert got.warnings == [f"{H.FILE_WARNING}{u}: not landed" for u in missing]
    assert results["fl_mac_fcso_otp"].linked_pdfs == ["https://medicare.fcso.com/b.pdf", "https://medicare.fcso.com/specialties/a.PDF"]
    broken = results["samhsa_tip_63"]
    assert broken.parsed_empty and broken.warnings[0].startswith("scrape_failed: ") and broken.full_text is None


def test_a_run_with_its_ptp_tables(spark, scratch):
    from regloom.operators import ncci
    from regloom.plans.reports import write_reports

    base = "https://www.cms.gov/p/"
    href = "medicare-ncci-2025q1-practitioner-ptp-edits-ccipra-v1r0-f1.zip"
    hrefs = spark.createDataFrame([(1, base, 0, href)], "page_id int, base_url string, href_pos int, href string")
    payloads = spark.createDataFrame([(base + href, "d1")], "url string, digest string")
    rows = spark.createDataFrame(
        [(base + href, 0, "x_additions.txt", None, i, c) for i, c in enumerate([["H0020", "80305", "1"], ["G2067", "99213", "0"], ["H0020", "80305", "9"]])],
        "url string, file_ord int, member string, sheet string, row_ord bigint, cells array<string>",
    )
    jobs = {"cms_ncci_edits": ncci.medicare_tables(hrefs, payloads, rows), "cms_ncci_medicaid": ncci.medicaid_tables(hrefs, payloads, rows)}
    out = os.path.join(scratch, "out")
    s = run(spark, landed(spark), out, "r1", tables=jobs)
    assert s.rule_count == 12
    rules = spark.read.json(os.path.join(out, "runs", "r1", "candidate_rules"))
    assert sorted((r.rule_id, r.code) for r in rules.where("logic_type = 'BundleGuard'").collect()) == [("R-NCCI-0000", "H0020"), ("R-NCCI-0001", "G2067")]
    summary = spark.read.option("header", True).csv(write_reports(spark, out, "r1")["run_summary"])
    got = {r.source_key: (r.status, r.extracted_count, r.extracted_unit, r.doc_label) for r in summary.collect()}
    assert got["cms_ncci_edits"] == ("OK", "2", "NCCI edits", "NCCI PTP Edits (practitioner, FULL table)")
    assert got["cms_ncci_medicaid"] == ("OK", "0", None, "Medicaid NCCI PTP Edits")
    assert got["ecfr_42_part_8"][3] == "42 CFR Part 8" and got["fl_mac_fcso_otp"][3] is None


def test_reports_of_a_run_without_rules(spark, scratch):
    from regloom.plans.reports import write_reports

    out = os.path.join(scratch, "out")
    nothing = run(spark, landed(spark), out, "r0", only=["asam_criteria"])
    assert (nothing.rule_count, nothing.chunk_count) == (0, 0)
    run(spark, landed(spark), out, "r1", only=["samhsa_tip_63"])
    t = spark.read.option("header", True).csv(write_reports(spark, out, "r1")["totals"]).first()
    assert (t.ok, t.fail, t.rule_count, t.chunk_count) == ("1", "0", "0", "3")


def test_streaming_many_batches_in_one_run(spark, scratch):
    src, sink, ckpt = (os.path.join(scratch, x) for x in ("land2", "chunks2", "ckpt2"))
    schema = "doc_id bigint, source_key string, label string, text string"
    for i, texts in enumerate([["a1", "b1"], ["a1", "c1"], ["c1", "d1"]]):
        spark.createDataFrame([(i * 10 + j, "s", "l", t) for j, t in enumerate(texts)], schema).coalesce(1).write.parquet(
            os.path.join(src, f"b{i}")
        )
    chunk_stream.run_available(spark, src, sink, ckpt, schema=schema, max_files_per_trigger=1)
    df = spark.read.parquet(sink)
    assert len(os.listdir(os.path.join(ckpt, "commits"))) >= 3
    assert sorted(r.text for r in df.collect()) == ["a1", "b1", "c1", "d1"]


def test_a_failed_promotion_leaves_the_old_version(spark, scratch):
    import pytest

    from regloom.sources import live

    out = os.path.join(scratch, "out")
    assert live.read_live(spark, out, "rule_id string") is None
    rules = lambda *ids: spark.createDataFrame([(i,) for i in ids], "rule_id string")
    live.promote(rules("R-1"), out, "v1")
    broken = rules("R-1", "R-2").select(F.when(F.col("rule_id") == "R-2", F.raise_error(F.lit("lost"))).otherwise(F.col("rule_id")).alias("rule_id"))
    with pytest.raises(Exception, match="lost"):
        live.promote(broken, out, "v2")
    assert live.live_version(spark, out) == "v1"
    live.write_version(rules("R-1", "R-3"), out, "v3")  # written, and the job ends before the pointer moves
    assert [r.rule_id for r in live.read_live(spark, out, "rule_id string").collect()] == ["R-1"]
    live.move_pointer(spark, out, "v3")
    now = live.read_live(spark, out, "rule_id string")
    assert sorted(r.rule_id for r in now.collect()) == ["R-1", "R-3"]
    assert all("version=v3" in f for f in now.inputFiles())
    live.move_pointer(spark, out, "v1")
    assert live.live_version(spark, out) == "v1"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        live.move_pointer(spark, out, "v9")
    assert live.live_version(spark, out) == "v1"


def test_known_ids_are_read_without_texts_and_exchange(spark, scratch):
    from regloom.sources import id_index

    out = os.path.join(scratch, "out")
    chunks = lambda *ids: spark.createDataFrame([(f"{i:016x}", "text") for i in ids], "chunk_id string, text string")
    tables = lambda: [t.name for t in spark.catalog.listTables()]
    before = tables()
    for run_id, ids in (("r1", range(500)), ("r2", range(400, 900)), ("r2", range(400, 900))):
        fresh = id_index.new_chunks(chunks(*ids), out, run_id)
        want = set(ids) - (set(range(500)) if run_id == "r2" else set())
        assert sorted(int(r.chunk_id, 16) for r in fresh.collect()) == sorted(want)
        id_index.add_ids(fresh, out, run_id)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = id_index.new_chunks(chunks(1, 1000), out, "r3")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 64 out of 64" in plan
    assert "ReadSchema: struct<chunk_id:string,run_id:string>" in plan
    assert tables() == before
