"""Composed handbook result (E5): one row per landing page.

The handbooks of a page are the known ones, in their order, then those its
links lead to, in document order; of equal URLs the first counts. Every listed
file is met with its text, facts are computed once per file (not once per page
that lists it), and a page's handbooks are gathered in listing order, texts in
full. Files that could not be fetched become warnings.

Inputs: ``parsed`` pages (page_id, url, anchors, ``error`` where the page
itself could not be fetched or read) and ``files`` (url, text, error: text null
where the fetch failed; at most one row per url). A listed url without a row
in ``files`` counts as a failed fetch.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.urls import url_join
from regloom.operators import extract as X
from regloom.operators.markup import KNOWN_HANDBOOK_PDFS, LABEL_CHARS

SOURCE_KEY = "fl_ahca_cbh_handbook"
# Warnings of the landing page and of a file.
LANDING_WARNING, FILE_WARNING = "AHCA landing fetch failed: ", "AHCA PDF fetch failed "

#: Fields of a handbook, in order.
FACTS = ["label", "url", "char_count", "mentions_HF_modifier", "mentions_POS_58", "mentions_HD_HG_pair", "h_codes_referenced", "excerpt", "full_text"]
ROLLUP = ["handbook_count", "any_HF_mentioned", "any_POS_58_mentioned", "any_HD_HG_pair_mentioned"]
HANDBOOK_TYPE = (
    "array<struct<label:string,url:string,char_count:int,mentions_HF_modifier:boolean,mentions_POS_58:boolean,"
    "mentions_HD_HG_pair:boolean,h_codes_referenced:array<string>,excerpt:string,full_text:string>>"
)


def is_handbook_link(href: Column, label: Column) -> Column:
    """A .pdf or a download path, unless the label names a media player."""
    low = F.lower(label)
    return (F.lower(href).endswith(".pdf") | href.contains("/content/download/")) & ~low.contains("windows") & ~low.contains("media")


def listed(parsed: DataFrame) -> DataFrame:
    """Rows (page_id, ord, label, url): known handbooks first, then the page's links; the first of equal URLs."""
    known = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(u).alias("url")) for n, u in KNOWN_HANDBOOK_PDFS])
    anchors = F.coalesce("anchors", F.array().cast("array<struct<href:string,label:string>>"))
    short = F.transform(anchors, lambda a: F.struct(F.substring(a["label"], 1, LABEL_CHARS).alias("label"), a["href"].alias("url")))
    linked = F.filter(short, lambda a: is_handbook_link(a["url"], a["label"]))
    rows = parsed.select("page_id", F.col("url").alias("_base"), F.posexplode(F.concat(known, linked)).alias("ord", "_l"))
    at = rows.select("page_id", "ord", F.col("_l.label").alias("label"), F.when(F.col("ord") < len(KNOWN_HANDBOOK_PDFS), F.col("_l.url")).otherwise(url_join(F.col("_base"), F.col("_l.url"))).alias("url"))
    first = at.groupBy("page_id", "url").agg(F.min(F.struct("ord", "label")).alias("_f"))
    return first.select("page_id", F.col("_f.ord").alias("ord"), F.col("_f.label").alias("label"), "url")


def file_facts(files: DataFrame) -> DataFrame:
    """Facts of every fetched file, and the error of the others."""
    return X.handbook_facts(files.withColumn("full_text", F.col("text")))


def gathered(rows: DataFrame, by: str = "page_id") -> DataFrame:
    """One row per page from rows (page_id, ord, a fetched file's facts or its error).

    A page lists a few dozen files, so its handbooks fit a row.
    """
    fetched = F.col("full_text").isNotNull()
    flags = ["mentions_HF_modifier", "mentions_POS_58", "mentions_HD_HG_pair"]
    in_order = lambda c: F.array_sort(F.collect_list(c))  # noqa: E731 - collect_list leaves out nulls
    out = rows.groupBy(by).agg(
        F.count_if(fetched).alias("handbook_count"),
        in_order(F.when(fetched, F.struct("ord", F.struct(*FACTS).alias("h")))).alias("_h"),
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(a) for f, a in zip(flags, ("any_HF_mentioned", "any_POS_58_mentioned", "any_HD_HG_pair_mentioned"), strict=True)],
        in_order(F.when(~fetched, F.struct("ord", F.concat(F.lit(FILE_WARNING), F.col("url"), F.lit(": "), F.coalesce("error", F.lit("not landed"))).alias("w")))).alias("_w"),
    )
    return out.select(
        by, F.lit(X.DOC_LABELS[SOURCE_KEY]).alias("doc"), "handbook_count", F.transform("_h", lambda x: x["h"]).cast(HANDBOOK_TYPE).alias("handbooks"),
        "any_HF_mentioned", "any_POS_58_mentioned", "any_HD_HG_pair_mentioned", F.transform("_w", lambda x: x["w"]).alias("warnings"),
    )


def handbook_results(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """E5: doc, handbook_count, handbooks, the three any-flags and warnings of every landing page."""
    rows = gathered(listed(parsed).join(file_facts(files.select("url", "text", "error")), "url", "left"))
    landing = parsed.where("error is not null").select("page_id", F.concat(F.lit(LANDING_WARNING), "error").alias("_landing"))
    warned = F.when(F.col("_landing").isNull(), F.col("warnings")).otherwise(F.concat(F.array("_landing"), F.col("warnings")))
    return rows.join(landing, "page_id", "left").withColumn("warnings", warned).drop("_landing")


def composed_results(results: DataFrame) -> DataFrame:
    """E5 in a run: the handbook source's landed rows as one result, the others as they are.

    ``results`` columns: source_key, source_url, source_name, result_ord,
    engine, fetched_at, warnings, full_text, parsed_empty; with ``document``
    (the file's URL; '' for the landing page) and ``anchors`` the handbooks are
    listed as on the page, and files that nothing lists follow in order of
    their names. Without ``document`` every row is a file of its own. The
    source has a few dozen files, so its rows fit one.
    """
    mine = F.col("source_key") == SOURCE_KEY
    own = results.where(mine)
    if "document" in results.columns:
        landing = F.coalesce("document", F.lit("")) == ""
        name = F.col("document")
        pages = own.groupBy(F.col("source_key").alias("page_id"), F.col("source_url").alias("url")).agg(
            F.first(F.when(landing, F.col("anchors")), ignorenulls=True).alias("anchors"),
            F.when(F.count_if(landing) == 0, "not landed").otherwise(F.max(F.when(landing, F.get("warnings", 0)))).alias("error"),
        )
        shown, warned = listed(pages), pages.where("error is not null").select("page_id", F.concat(F.lit(LANDING_WARNING), "error").alias("_landing"))
    else:
        landing, name = F.lit(False), F.col("raw_path")
        shown, warned = None, None
    files = own.where(~landing).select(name.alias("url"), F.col("source_name").alias("label"), F.col("full_text").alias("text"), F.get("warnings", 0).alias("error"))
    if shown is None:
        rows = file_facts(files).withColumns({"ord": F.lit(0), "page_id": F.lit(SOURCE_KEY)})
    else:
        rows = shown.join(file_facts(files.drop("label")), "url", "full_outer").withColumns({
            "ord": F.coalesce("ord", F.lit(1 << 30)), "label": F.coalesce("label", "url"), "page_id": F.coalesce("page_id", F.lit(SOURCE_KEY)),
        })
    made = gathered(rows)
    if warned is not None:
        made = made.join(warned, "page_id", "left").withColumn("warnings", F.concat(F.when(F.col("_landing").isNull(), F.array().cast("array<string>")).otherwise(F.array("_landing")), "warnings")).drop("_landing")
    # One row per source with the catalog's columns; a source of which nothing could be read stays a failed one.
    head = own.groupBy("source_key", "source_name", "result_ord", "engine").agg(
        F.max("fetched_at").alias("fetched_at"), F.max(F.when(F.col("parsed_empty"), F.get("warnings", 0))).alias("_failed")
    )
    whole = head.join(made.withColumnRenamed("page_id", "source_key"), "source_key").withColumn("parsed_empty", (F.col("handbook_count") == 0) & F.col("_failed").isNotNull())
    composed = whole.withColumn("warnings", F.when(F.col("parsed_empty"), F.concat(F.array("_failed"), "warnings")).otherwise(F.col("warnings"))).drop("_failed")
    composed = composed.withColumns({"content_sha256": F.lit(""), "raw_path": F.lit("")})
    return results.where(~mine).unionByName(composed, allowMissingColumns=True)
