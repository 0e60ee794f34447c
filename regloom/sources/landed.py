"""Landed raw files -> the ``landed`` input of ``plans.run`` (S4 -> E glue).

``<root>/<source_key>/[<document>/]<sha12><suffix>``: text-like payloads
(.txt, .html, .xml) are decoded in the JVM (``CAST(content AS STRING)``,
UTF-8); HTML goes through the page parser (main text and links), eCFR XML
through the section parser. A source with several documents lands each in a
folder of its own, named by the document's URL (percent-encoded). The newest
file of each (source, document) wins (max modificationTime, a partial
aggregate); a handbook text without a folder is a document by itself. What can
not be parsed becomes a failed result with the error among its warnings (S6).
PDF decoding is not built: PDF sources must be landed as extracted .txt.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.operators import markup as MK
from regloom.operators.handbooks import SOURCE_KEY as HANDBOOK_KEY
from regloom.sources.raw import below

DECODED_SCHEMA = (
    "source_key string, document string, fetched_at string, content_sha256 string, raw_path string, text string, warnings array<string>, "
    "sections array<struct<id:string,label:string,text:string>>, kept_links array<string>, anchors array<struct<href:string,label:string>>"
)
_PASSED = ["source_key", "document", "fetched_at", "content_sha256", "raw_path"]


def _decoded(kind: str, body: str) -> dict:
    """One file: HTML -> main text and links, XML -> sections, anything else -> the decoded text itself."""
    out = {"text": None, "warnings": [], "sections": None, "kept_links": None, "anchors": None}
    if kind == "html":
        page, error = MK.read_page(body)
        if error is None:
            out |= {"text": " ".join(page.text), "kept_links": page.kept_links, "anchors": [{"href": h, "label": lab} for h, lab in page.all_links]}
    elif kind == "xml":
        out["sections"], error = MK.read_sections(body)
    else:
        out["text"], error = body, None
    return out if error is None else out | {"warnings": [MK.SCRAPE_FAILED + error]}


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [_decoded(kind, body or "") for kind, body in zip(pdf["kind"], pdf["body"], strict=True)]
        yield pd.DataFrame({c: pdf[c] for c in _PASSED} | {c: [r[c] for r in rows] for c in ("text", "warnings", "sections", "kept_links", "anchors")})


def landed_documents(spark: SparkSession, root: str) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{txt,html,xml}")
        .load(root)
    )
    key, folder, name = (below(root, part) for part in (1, 2, 3))
    document = F.coalesce(F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))), folder)
    alone = (key == HANDBOOK_KEY) & name.endswith(".txt") & (folder == "")
    named = files.withColumn("source_key", key).withColumn("document", F.when(alone, name).otherwise(document))
    # Newest file per document from metadata only (binaryFile skips the content
    # column when it is not selected); AQE broadcasts the path list where it is small.
    newest = named.groupBy("source_key", "document").agg(F.max(F.struct("modificationTime", "path")).alias("_n")).select(F.col("_n.path").alias("path"))
    chosen = named.join(newest, "path", "left_semi")
    base = chosen.select(
        "source_key",
        "document",
        F.date_format(F.col("modificationTime"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
        F.sha2(F.col("content"), 256).alias("content_sha256"),
        F.col("path").alias("raw_path"),
        F.col("content").cast("string").alias("body"),
        F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)).alias("kind"),
    )
    return base.mapInPandas(_decode, DECODED_SCHEMA)
