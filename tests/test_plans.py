"""Plan-shape checks over every registered query (the scale contract)."""
import pytest

from regloom.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
PYTHON_STAGES = {"page_main_text", "page_status", "fcso_page_facts", "handbook_links", "handbook_results", "ecfr_sections", "diff_params"}


def plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(q.build(spark, SF)) for n, q in all_queries().items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_no_row_at_a_time_python(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p] == []


def test_python_only_in_parser_stages(plans):
    users = {n for n, p in plans.items() if "MapInPandas" in p or "ArrowEvalPython" in p}
    assert users <= PYTHON_STAGES


def test_chunking_and_extraction_are_map_only(plans):
    for n in ["chunk_windows", "chunk_paragraphs", "chunk_routes", "extract_cms_ch17", "extract_facts_dispatch", "extract_simply"]:
        assert "Exchange" not in plans[n], n


def test_scans_are_pruned(plans):
    p = plans["chunk_windows"]
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in p or (
        "n_chars" not in p.split("FileScan")[1].split("ReadSchema")[1].split("\n")[0]
    )


def test_dedupe_is_partial_aggregation(plans):
    p = plans["ptp_relevant_edits"]
    assert "partial_min" in p and "Window" not in p


def test_no_global_single_partition_windows_on_data(plans):
    """A SinglePartition exchange may only feed a final global aggregate (after
    partial aggregation) or the table of one row per run of results of the
    numbering; never a window or sort over data rows."""
    for n, p in plans.items():
        lines = [x for x in p.split("\n") if x.strip()]
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line or i == 0:
                continue
            parent = lines[i - 1]
            ok = "Aggregate" in parent or "[bucket#" in parent
            assert ok, (n, parent.strip()[:120])


def test_multi_check_audits_scan_claims_once(plans):
    for n in ["audit_bundle_iop", "audit_claim_lines", "audit_same_day_pairs"]:
        assert plans[n].count("FileScan parquet [l_orderkey") == 1, n


def test_link_selection_scans_pages_once(plans):
    for n in ["ncci_full_table_parts", "ncci_delta_fallback", "medicaid_ptp_zips"]:
        assert plans[n].count("FileScan parquet [page_id") == 1, n


def test_samples_chunk_three_documents_only(plans):
    p = plans["chunk_samples"]
    lines = [x for x in p.split("\n")]
    generate = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert any("TakeOrderedAndProject(limit=3, orderBy=[doc_id" in x for x in lines[generate:])


def test_counts_cut_no_texts(plans):
    for n in ["chunks_per_source", "run_totals"]:
        assert "Generate" not in plans[n] and "sha2" not in plans[n], n
