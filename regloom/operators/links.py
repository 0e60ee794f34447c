"""PTP download-link selection on crawled pages.

Input ``hrefs``: page_id, base_url, href_pos, href (one row per anchor).

All choices per page start with partial aggregates (min position per page,
release and part), so a page with a huge link list is reduced map-side; the
newest release is then picked by a window over those few aggregated rows.
Each query scans the hrefs once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.functions import regex as R
from regloom.functions.urls import resolve_cms_href, url_join

# Link patterns (case-insensitive search).
RE_FULL_PRACTITIONER = (
    r"medicare-ncci-(\d{4})q(\d)-practitioner-ptp-edits-ccipra-v(\d+)r(\d+)-f(\d+)\.zip"
)
RE_DELTA_PRACTITIONER = r"practitioner.*(?:additions|deletions|revisions|quarterly).*\.zip"
RE_MEDICAID_PTP = (
    r"(?=.*medicaid)(?=.*ptp)(?=.*practitioner)"
    r"(?!.*\bmue\b)(?!.*outpatient)(?!.*hospital)(?!.*durable)(?!.*\bdme\b)"
    r".*\.zip"
)
RE_YEAR = r"(20\d{2})"
RE_QTR = r"q([1-4])"  # case-insensitive
RE_HREF = r"""<a\s[^>]*?href="([^"]*)\""""

NO_LINK_WARNING = "No practitioner PTP zip link (full table or delta) found"
DELTA_WARNING = "Full PTP table not found; fell back to quarterly delta zip"


def page_hrefs(pages: DataFrame) -> DataFrame:
    """Anchor hrefs of each page in document order (regex form of the HTML walk)."""
    links = R.find_all(F.col("html"), RE_HREF, 1, ignore_case=True)
    return pages.select(
        "page_id", F.col("url").alias("base_url"), F.posexplode(links).alias("href_pos", "href")
    )


def _num(p: str, g: int):
    return F.regexp_extract(F.col("href"), R.pattern(p, ignore_case=True), g).try_cast("bigint")


def full_table_parts(hrefs: DataFrame) -> DataFrame:
    """L1 + L5: all parts of the newest (year, qtr, vmaj, vmin) per page, one row
    per part (first href per part wins), resolved; ``part`` is the order key."""
    pat = R.pattern(RE_FULL_PRACTITIONER, ignore_case=True)
    m = hrefs.filter(F.col("href").rlike(pat)).select(
        "page_id",
        "base_url",
        "href_pos",
        "href",
        F.struct(_num(RE_FULL_PRACTITIONER, 1).alias("y"), _num(RE_FULL_PRACTITIONER, 2).alias("q"),
                 _num(RE_FULL_PRACTITIONER, 3).alias("vmaj"), _num(RE_FULL_PRACTITIONER, 4).alias("vmin")).alias("rel"),
        _num(RE_FULL_PRACTITIONER, 5).alias("part"),
    )
    # One row per (page, release, part) first, then the newest release per page
    # by a window over those few rows: the hrefs are scanned once.
    first = m.groupBy("page_id", "rel", "part").agg(F.min(F.struct("href_pos", "href", "base_url")).alias("f"))
    newest = F.max("rel").over(Window.partitionBy("page_id"))
    chosen = first.withColumn("_best", newest).filter(F.col("rel") == F.col("_best"))
    return chosen.select(
        "page_id",
        "part",
        F.col("f.href_pos").alias("href_pos"),
        resolve_cms_href(F.col("f.href"), F.col("f.base_url")).alias("url"),
    )


def delta_fallback(hrefs: DataFrame) -> DataFrame:
    """L2: per page without full-table parts, the first delta link (plain join
    onto the base URL) with its warning, or no link with the other warning.

    One aggregation per page: "has a full-table link" (then L1 is not empty)
    and the first delta link, so the hrefs are scanned once."""
    full = R.pattern(RE_FULL_PRACTITIONER, ignore_case=True)
    delta = R.pattern(RE_DELTA_PRACTITIONER, ignore_case=True)
    per_page = hrefs.groupBy("page_id").agg(
        F.bool_or(F.col("href").rlike(full)).alias("_has_full"),
        F.min(F.when(F.col("href").rlike(delta), F.struct("href_pos", "href", "base_url"))).alias("f"),
    )
    j = per_page.filter(~F.col("_has_full"))
    found = F.col("f").isNotNull()
    return j.select(
        "page_id",
        F.when(found, F.lit("delta")).otherwise(F.lit("none")).alias("table_scope"),
        F.when(found, url_join(F.col("f.base_url"), F.col("f.href"))).alias("url"),
        F.when(found, F.lit(DELTA_WARNING)).otherwise(F.lit(NO_LINK_WARNING)).alias("warning"),
    )


def release_key(href):
    """L4: (first 20xx, first q1..q4), 0 when absent."""
    y = F.regexp_extract(href, R.pattern(RE_YEAR), 1)
    q = F.regexp_extract(href, R.pattern(RE_QTR, ignore_case=True), 1)
    return F.struct(
        F.coalesce(F.nullif(y, F.lit("")).try_cast("int"), F.lit(0)).alias("year"),
        F.coalesce(F.nullif(q, F.lit("")).try_cast("int"), F.lit(0)).alias("quarter"),
    )


def medicaid_zips(hrefs: DataFrame) -> DataFrame:
    """L3: newest-release practitioner Medicaid PTP zips, distinct resolved URLs
    in first-seen order (``first_pos``)."""
    pat = R.pattern(RE_MEDICAID_PTP, ignore_case=True)
    m = hrefs.filter(F.col("href").rlike(pat)).select("page_id", "href_pos", "href", "base_url", release_key(F.col("href")).alias("rel"))
    per_href = m.groupBy("page_id", "rel", "href", "base_url").agg(F.min("href_pos").alias("first_pos"))
    newest = F.max("rel").over(Window.partitionBy("page_id"))
    chosen = per_href.withColumn("_best", newest).filter(F.col("rel") == F.col("_best"))
    # Only the winners are resolved; the rows of a page are together by now.
    resolved = chosen.select("page_id", resolve_cms_href(F.col("href"), F.col("base_url")).alias("url"), "first_pos")
    return resolved.groupBy("page_id", "url").agg(F.min("first_pos").alias("first_pos"))
