"""End-to-end run (query lifecycle 3.1) and promotion.

landed documents -> select + registry (S2, S3) -> facts in one pass (E) ->
results written per run (S7; this also cuts lineage) -> three branches read
the written table: rules (M) -> candidate, diff against the live version (D),
chunks for engine-2 sources (C). The only driver action that decides
anything is ``is_material``; promotion writes a new version and then moves the
pointer to it (sources.live), and known chunk ids are an index of ids alone
(sources.id_index).

``landed`` columns: source_key, fetched_at, content_sha256, raw_path, text,
warnings ARRAY<STRING>; optional: sections (for the section route), kept_links
(the FCSO page's PDFs), document and anchors (the handbook source's files and
its page's links). The handbook source's rows become one result (E5).
``tables`` adds the PTP sources: their jobs' results and edits (E7, E8).
``run_id`` names the run's folders and the version it may promote.
"""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.operators import chunks as C
from regloom.operators import diff as D
from regloom.operators import extract as X
from regloom.operators import handbooks as H
from regloom.operators import markup as MK
from regloom.operators import matrix as M
from regloom.operators.ncci import TableJobs
from regloom.operators.report import failed
from regloom.sources import catalog as S
from regloom.sources import id_index, sinks
from regloom.sources.live import promote as promote_rules
from regloom.sources.live import read_live

COMPARE_COLS = ["payer_type", "code", "required_modifier", "logic_type", "friendly_message"]


@dataclass
class RunSummary:
    rule_count: int
    chunk_count: int
    diff_material: bool
    promoted: bool
    new_chunk_count: int = 0


def select_results(spark: SparkSession, landed: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Catalog order, selection, registry; unregistered sources drop out."""
    cat = S.registered(S.select_sources(S.catalog_df(spark), only), spark)
    dims = cat.select(
        F.col("key").alias("source_key"), F.col("catalog_ord").cast("bigint").alias("result_ord"),
        F.col("name").alias("source_name"), "engine", F.col("url").alias("source_url"),
    )
    return landed.join(F.broadcast(dims), "source_key")


def with_facts(results: DataFrame) -> DataFrame:
    """E: facts for every source in one projection; failed sources get none."""
    base = results if "sections" in results.columns else results.withColumn(
        "sections", F.lit(None).cast("array<struct<id:string,label:string,text:string>>")
    )
    facts = X.extract_facts(base, every_source=True).withColumn("doc", X.doc_label(F.col("source_key")))
    if "kept_links" in facts.columns:
        pdfs = MK.linked_pdfs(F.col("source_url"), F.col("kept_links"))
        facts = facts.withColumn("linked_pdfs", F.when(F.col("source_key") == "fl_mac_fcso_otp", pdfs))
    return facts.withColumn("parsed_empty", failed(F.col("warnings")))


def run_results(spark: SparkSession, landed: DataFrame, only: list[str] | None = None) -> DataFrame:
    """One result per source of the catalog, the handbook source's files composed (E5)."""
    results = H.composed_results(with_facts(select_results(spark, landed, only)))
    return results.drop("source_url", "kept_links", "anchors", "document")


def with_tables(spark: SparkSession, results: DataFrame, tables: Mapping[str, TableJobs], only: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The PTP sources' results, one row per source, and their edits with positions."""
    cat = S.select_sources(S.catalog_df(spark), only).select(
        F.col("key").alias("source_key"), F.col("catalog_ord").cast("bigint").alias("result_ord"), F.col("name").alias("source_name"), "engine"
    )
    edits = None
    for key, jobs in tables.items():
        dims = F.broadcast(cat.where(F.col("source_key") == key))
        counted = F.when(F.col("table_scope") != "none", F.col("edit_count_relevant"))
        facts = jobs.results.drop("page_id").withColumns({"source_key": F.lit(key), "edit_count_relevant": counted}).join(dims, "source_key")
        results = results.unionByName(facts.withColumn("parsed_empty", failed(F.col("warnings"))), allowMissingColumns=True)
        own = jobs.edits.withColumn("source_key", F.lit(key)).join(dims.select("source_key", "result_ord"), "source_key")
        edits = own if edits is None else edits.unionByName(own)
    return results, M.number_edits(edits)


def run(
    spark: SparkSession,
    landed: DataFrame,
    out_root: str,
    run_id: str,
    *,
    only: list[str] | None = None,
    promote: bool = False,
    edits: DataFrame | None = None,
    tables: Mapping[str, TableJobs] | None = None,
    engine1_only: bool = False,
    scope_diff_to_seen: bool = False,
) -> RunSummary:
    root = out_root.rstrip("/")
    results = run_results(spark, landed, only)
    if tables:
        results, edits = with_tables(spark, results, tables, only)
    sinks.write_results(results, root, run_id)
    stored = sinks.read_results(spark, root, run_id, results.schema)

    # Rules (M). The matrix function takes any results (Q1); the reference's
    # pipeline feeds engine-1 sources only, available as engine1_only.
    e1 = stored.filter(F.col("engine") == "engine1") if engine1_only else stored
    rules = M.build_rules(e1, edits)
    handbooks = stored.filter((F.col("source_key") == H.SOURCE_KEY) & ~F.col("parsed_empty"))
    sinks.write_json(handbooks.select("source_key", "doc", *H.ROLLUP, "handbooks"), f"{root}/runs/{run_id}/handbooks")
    cand_path = sinks.write_json(rules, f"{root}/runs/{run_id}/candidate_rules")
    cand = spark.read.json(cand_path, schema=rules.schema)

    # Diff (D) against the live version.
    live = read_live(spark, root, rules.schema)
    if live is None:
        changes = D.first_deploy(cand).drop("rule_ord")
        first = True
    else:
        if scope_diff_to_seen:
            seen = stored.select("source_key").distinct()
            live = live.join(seen, "source_key", "left_semi")
        changes = D.diff_rules(live, cand, COMPARE_COLS, params_col="params_json")
        first = False
    diff_path = sinks.write_json(changes, f"{root}/runs/{run_id}/diff")
    summary_path = sinks.write_json(
        D.summary(spark.read.json(diff_path, schema=changes.schema), first_deploy=first), f"{root}/runs/{run_id}/diff_summary"
    )
    material = bool(spark.read.json(summary_path).select("is_material").first()[0])

    # Matrix header and provenance next to the rules.
    sinks.write_json(M.header(cand), f"{root}/runs/{run_id}/matrix_header")
    sinks.write_json(M.provenance(e1), f"{root}/runs/{run_id}/matrix_sources")

    # Chunks (C) for engine-2 sources.
    e2 = C.route_engine2(stored, S.catalog_df(spark))
    chunks = C.chunk_for_rag(e2)
    chunk_path = sinks.write_json(chunks, f"{root}/runs/{run_id}/chunks")
    # Only chunk ids no earlier run produced need embedding.
    stored_chunks = spark.read.json(chunk_path, schema=chunks.schema)
    new_path = sinks.write_json(id_index.new_chunks(stored_chunks, root, run_id).select(*chunks.columns), f"{root}/runs/{run_id}/new_chunks")
    fresh = spark.read.json(new_path, schema=chunks.schema)
    id_index.add_ids(fresh, root, run_id)

    promoted = promote and material
    if promoted:
        promote_rules(cand, root, run_id)

    rule_count = spark.read.json(cand_path, schema=rules.schema).count()
    chunk_count = spark.read.json(chunk_path, schema=chunks.schema).count()
    return RunSummary(rule_count, chunk_count, material, promoted, fresh.count())
