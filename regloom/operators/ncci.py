"""PTP table jobs (E7 Medicare full table or delta, E8 Medicaid) over many pages.

Link choice per page (L1-L3), the rows of the chosen files, filter and
first-wins dedupe within the page (P6), and one result row per page: scope,
sources, counts, digest (S5) and warnings.

Inputs: ``hrefs`` (page_id, base_url, href_pos, href), ``payloads`` (url,
digest; optional is_zip: the files that were fetched, one row per url) and
``rows`` (url, file_ord, member, sheet, row_ord, cells: their unpacked rows);
optional ``pages`` (page_id) where some pages have no link at all. A chosen
file without a payload counts as a failed fetch, a payload that is no zip as a
license redirect: both are skipped and warned of, the first is not in the
digest. A page's only file (the delta zip) failing fails the result.

Files are listed by many pages, so their rows are filtered and deduplicated
once per file before they meet the pages.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.operators import extract as X
from regloom.operators import links as L
from regloom.operators import ptp as P
from regloom.operators.markup import SCRAPE_FAILED

# Warnings of pages and files.
NO_MEDICAID_WARNING = "No Medicaid PTP zip link found on the edit-files page"
NOT_FETCHED, NOT_A_ZIP = " (fetch failed): ", "Not a zip (license redirect?): "

#: Results of both jobs.
RESULT_COLUMNS = ["page_id", "doc", "table_scope", "source_zips", "part_count", "edit_count_relevant", "content_sha256", "warnings"]


@dataclass
class TableJobs:
    results: DataFrame  # RESULT_COLUMNS
    edits: DataFrame  # page_id, part_ord, file_ord, row_ord + EDIT_COLUMNS


def file_edits(rows: DataFrame) -> DataFrame:
    """P1-P6 within each file: url, file_ord, row_ord + EDIT_COLUMNS."""
    found = P.candidate_edits(rows.withColumn("part_ord", F.lit(0)), group=("url",))
    return P.first_wins(found, key=["url", "column1", "column2", "edit_kind"], order=["file_ord", "row_ord"], payload=["modifier_indicator", "source_file"])


def _jobs(pages: DataFrame, chosen: DataFrame, payloads: DataFrame, rows: DataFrame, skipped: str) -> TableJobs:
    """pages: page_id, doc, table_scope, note, whole (the page's only file is the result); chosen: page_id, part_ord, url."""
    zipped = F.coalesce("is_zip", F.lit(True)) if "is_zip" in payloads.columns else F.lit(True)
    fetched = chosen.join(payloads.select("url", "digest", zipped.alias("is_zip")), "url", "left")
    listed = F.col("digest").isNotNull() & F.col("is_zip")
    # A listed file is a short row here and all its edits behind the join, so they are dealt out by page, into all partitions, before they are sorted.
    parts_of_job = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_pages = fetched.where(listed).select("page_id", "part_ord", "url").join(file_edits(rows), "url").repartition(parts_of_job, "page_id")
    edits = P.first_wins(
        of_pages, key=["page_id", "column1", "column2", "edit_kind"], order=["part_ord", "file_ord", "row_ord"], payload=["modifier_indicator", "source_file"]
    ).select("page_id", "part_ord", "file_ord", "row_ord", *P.EDIT_COLUMNS)
    # A page lists a handful of files, so its lists are short.
    parts_of = fetched.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("part_ord", "url", "digest", "is_zip"))).alias("parts"))
    counted = edits.groupBy("page_id").agg(F.count(F.lit(1)).alias("edit_count_relevant"))
    all_ = pages.join(parts_of, "page_id", "left").join(counted, "page_id", "left")
    parts = F.coalesce("parts", F.array().cast("array<struct<part_ord:bigint,url:string,digest:string,is_zip:boolean>>"))
    digests = F.filter(F.transform(parts, lambda p: p["digest"]), lambda d: d.isNotNull())

    def warning(p: Column) -> Column:
        return F.when(p["digest"].isNull(), F.concat(F.lit(skipped + NOT_FETCHED), p["url"])).when(~p["is_zip"], F.concat(F.lit(NOT_A_ZIP), p["url"]))

    warned = F.filter(F.transform(parts, warning), lambda w: w.isNotNull())
    digest = F.when(F.size(parts) == 0, F.lit("")).when(F.col("whole"), F.coalesce(F.get(digests, 0), F.lit(""))).otherwise(F.sha2(F.array_join(digests, ""), 256))
    broken = F.col("whole") & (F.size(warned) > 0)
    none = F.array().cast("array<string>")
    fact = lambda c: F.when(~broken, c)
    results = all_.select(
        "page_id", fact(F.col("doc")).alias("doc"), fact(F.col("table_scope")).alias("table_scope"),
        F.when(broken, none).otherwise(F.transform(parts, lambda p: p["url"])).alias("source_zips"),
        F.when(broken, 0).otherwise(F.size(parts)).alias("part_count"),
        F.coalesce("edit_count_relevant", F.lit(0)).cast("bigint").alias("edit_count_relevant"),
        F.when(broken, F.lit("")).otherwise(digest).alias("content_sha256"),
        F.when(broken, F.transform(warned, lambda w: F.concat(F.lit(SCRAPE_FAILED), w)))
        .otherwise(F.concat(warned, F.when(F.col("note").isNull(), none).otherwise(F.array("note")))).alias("warnings"),
    )
    return TableJobs(results, edits)


def _facts(df: DataFrame, doc: str | Column, scope: str | Column, note: Column, whole: bool) -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select("page_id", as_column(doc).alias("doc"), as_column(scope).alias("table_scope"), note.cast("string").alias("note"), F.lit(whole).alias("whole"))


def medicare_tables(hrefs: DataFrame, payloads: DataFrame, rows: DataFrame, pages: DataFrame | None = None) -> TableJobs:
    """Per page the newest full table (all parts), else its delta zip with
    a warning, else an empty result with the other warning."""
    parts = L.full_table_parts(hrefs).select("page_id", F.col("part").cast("bigint").alias("part_ord"), "url")
    fallback = L.delta_fallback(hrefs)
    delta = fallback.where(F.col("table_scope") == "delta").select("page_id", F.lit(0).cast("bigint").alias("part_ord"), "url")
    full = _facts(parts.select("page_id").distinct(), X.DOC_LABELS["cms_ncci_edits"], "full", F.lit(None), False)
    is_delta = F.col("table_scope") == "delta"
    other = _facts(fallback, F.when(is_delta, X.NCCI_DELTA_DOC).otherwise(X.NCCI_NO_LINK_DOC), F.col("table_scope"), F.col("warning"), True)
    seen = full.unionByName(other)
    if pages is not None:
        linkless = pages.select("page_id").join(hrefs.select("page_id").distinct(), "page_id", "left_anti")
        seen = seen.unionByName(_facts(linkless, X.NCCI_NO_LINK_DOC, "none", F.lit(L.NO_LINK_WARNING), True))
    return _jobs(seen, parts.unionByName(delta), payloads, rows, "Skipped part")


def medicaid_tables(hrefs: DataFrame, payloads: DataFrame, rows: DataFrame, pages: DataFrame | None = None) -> TableJobs:
    """Per page the newest practitioner zips; an empty result with a warning without any."""
    chosen = L.medicaid_zips(hrefs).select("page_id", F.col("first_pos").cast("bigint").alias("part_ord"), "url")
    found = chosen.select("page_id").distinct().withColumn("found", F.lit(True))
    known = (hrefs if pages is None else pages).select("page_id").distinct().join(found, "page_id", "left")
    seen = _facts(
        known,
        F.when(F.col("found"), X.DOC_LABELS["cms_ncci_medicaid"]).otherwise(X.MEDICAID_NO_LINK_DOC),
        F.when(F.col("found"), "medicaid_ptp").otherwise("none"),
        F.when(F.col("found").isNull(), NO_MEDICAID_WARNING),
        False,
    )
    return _jobs(seen, chosen, payloads, rows, "Skipped zip")
