"""Report plan (lifecycle 3.3): read one run's persisted tables, write CSVs.

Reads the run-partitioned results, the candidate rules and the chunks written
by ``plans.run.run`` (so this job is joined to the run only through storage,
as in the source pipeline), and writes run_summary (R1-R3), rules (R4),
chunks (R5) and totals (R6) as CSV with headers (S11). Raw-file sizes come
from the landed raw folder when one is given (R3).
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from regloom.operators import report as RP
from regloom.operators.matrix import RULE_COLUMNS
from regloom.sources import raw, sinks

RULES_SCHEMA = "rule_ord bigint, " + ", ".join(f"{c} string" for c in RULE_COLUMNS)
CHUNKS_SCHEMA = "result_ord bigint, unit_ord int, window_ord int, chunk_id string, source_key string, label string, text string, char_count int"


def write_reports(spark: SparkSession, out_root: str, run_id: str, raw_root: str | None = None) -> dict[str, str]:
    root = out_root.rstrip("/")
    results = sinks.read_results(spark, root, run_id)
    # Schemas are given: a run without rules or chunks has files without a row to infer from.
    rules = spark.read.json(f"{root}/runs/{run_id}/candidate_rules", schema=RULES_SCHEMA)
    chunks = spark.read.json(f"{root}/runs/{run_id}/chunks", schema=CHUNKS_SCHEMA)
    parsed = ~F.col("parsed_empty")
    fact = lambda c: F.when(parsed, F.col(c)) if c in results.columns else F.lit(None)
    sections = F.when(parsed & F.col("sections").isNotNull(), F.size("sections")) if "sections" in results.columns else F.lit(None)
    cols = {"section_count": sections, **{c: fact(c) for c in ("edit_count_relevant", "g_codes_mentioned", "candidate_links")}}
    files = raw.file_sizes(spark, raw_root) if raw_root else None
    summary = RP.run_summary(results, files, cols).select(
        "source_key", "source_name", "status", "fetched_at", "raw_bytes", "content_sha256",
        "extracted_count", "extracted_unit", F.coalesce(fact("doc"), F.lit("")).alias("doc_label"), F.col("warnings_text").alias("warnings"), "file_name",
    ).orderBy("file_name")
    out = {
        "run_summary": sinks.write_csv(summary.drop("file_name"), f"{root}/reports/{run_id}/run_summary"),
        "rules": sinks.write_csv(RP.rules_flat(rules).orderBy("rule_ord").drop("rule_ord"), f"{root}/reports/{run_id}/rules"),
        "chunks": sinks.write_csv(
            RP.chunk_table(chunks).select("chunk_id", "source_key", "label", "char_count", "preview"), f"{root}/reports/{run_id}/chunks"
        ),
        "totals": sinks.write_csv(RP.totals(results, rules, chunks), f"{root}/reports/{run_id}/totals"),
    }
    return out
