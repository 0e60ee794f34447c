"""Procedure-to-procedure (PTP) edit rows: filter, classify, first-wins dedupe (P1-P6),
combined part digest (S5).

Raw input shape (one row per spreadsheet / text line):
  part_ord INT   position of the zip part (0 when there is one)
  file_ord INT   position of the member inside the part
  member STRING  member file name
  sheet STRING   worksheet title (null for text files)
  row_ord BIGINT line / row position inside the member
  cells ARRAY<STRING>

Plan at scale: the filters (P1, P2) are narrow and run inside the scan stage,
so only relevant rows reach the shuffles of the dedupe (P5). Repeats are first
reduced by a hash aggregate, then ``min(struct(ord..., payload))`` picks one row
per key. Both are partial aggregates, so a key that holds a third of all rows is
collapsed map-side to a few rows per partition before the first shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions import regex as R

# HCPCS codes the rule engine evaluates.
RELEVANT_CODES = [
    "G2067", "G2068", "G2069", "G2070", "G2071", "G2072", "G2073",
    "G2074", "G2075", "G2076", "G2077", "G2078", "G2079", "G2080",
    "G2086", "G2087", "G2088",
    "G1028", "G2215",
    "G0137",
    "H0001", "H0004", "H0005", "H0006", "H0020", "H0033", "H0047",
    "H0050", "H2010", "H2017",
]
HCPCS_SHAPE = r"^[A-Z0-9]{5}$"
MODIFIER_VALUES = ["0", "1", "9"]

EDIT_COLUMNS = ["column1", "column2", "modifier_indicator", "edit_kind", "source_file"]


def cell(cells: Column, i: int) -> Column:
    """Cell i (0-based) stripped, '' when missing or null.

    ``get`` returns null past the end; ``try_element_at`` inside a filter hits
    a codegen compile failure in Spark 4.1 (interpreted fallback), so it is
    avoided on this path.
    """
    return R.py_strip(F.coalesce(F.get(cells, i), F.lit("")))


def looks_like_hcpcs(code: Column) -> Column:
    """Five upper-case letters or digits."""
    return code.rlike(R.pattern(HCPCS_SHAPE))


def modifier_indicator(cells: Column) -> Column:
    """First cell from the third on whose stripped first line is 0, 1 or 9; else ''.

    Covers both layouts (indicator in cell 2 of the delta files, cell 5 of the
    full table).
    """
    tail = F.slice(cells, 3, F.greatest(F.size(cells) - 2, F.lit(0)))
    tokens = F.transform(tail, lambda c: R.py_strip(F.substring_index(R.py_strip(c), "\n", 1)))
    hits = F.filter(tokens, lambda t: t.isin(MODIFIER_VALUES))
    return F.coalesce(F.get(hits, 0), F.lit(""))


def sheet_kind(sheet: Column, member: Column) -> Column:
    """Worksheet kind from 'sheet member' lower-cased, by substring test."""
    name = F.lower(F.concat_ws(" ", F.coalesce(sheet, F.lit("")), member))
    return (
        F.when(name.contains("add"), "addition")
        .when(name.contains("del"), "deletion")
        .when(name.contains("ccmi") | name.contains("chg") | name.contains("change"), "ccmi_change")
        .otherwise("ptp_edit")
    )


def member_kind(member: Column, sheet: Column) -> Column:
    """Kind per member: text files by additions/deletions in the name
    (additions tested first), workbooks by sheet kind; others are not read."""
    low = F.lower(member)
    txt = low.endswith(".txt") & (low.contains("additions") | low.contains("deletions"))
    return (
        F.when(txt & low.contains("additions"), "addition")
        .when(txt, "deletion")
        .when(low.endswith(".xlsx"), sheet_kind(sheet, member))
    )


def source_file(member: Column, sheet: Column) -> Column:
    low = F.lower(member)
    return F.when(low.endswith(".xlsx"), F.concat(member, F.lit("#"), F.coalesce(sheet, F.lit("")))).otherwise(member)


def candidate_edits(raw: DataFrame, codes: list[str] = RELEVANT_CODES, group: tuple[str, ...] = ()) -> DataFrame:
    """P1-P4 on raw rows: narrow filters, no shuffle."""
    kind = member_kind(F.col("member"), F.col("sheet"))
    c1, c2 = cell(F.col("cells"), 0), cell(F.col("cells"), 1)
    staged = raw.select(
        *group,
        "part_ord",
        "file_ord",
        "row_ord",
        c1.alias("column1"),
        c2.alias("column2"),
        kind.alias("edit_kind"),
        source_file(F.col("member"), F.col("sheet")).alias("source_file"),
        "cells",
    ).filter(
        F.col("cells").isNotNull()
        & (F.size("cells") >= 2)
        & F.col("edit_kind").isNotNull()
        & looks_like_hcpcs(F.col("column1"))
        & looks_like_hcpcs(F.col("column2"))
        & (F.col("column1").isin(codes) | F.col("column2").isin(codes))
    )
    return staged.select(
        *group,
        "part_ord",
        "file_ord",
        "row_ord",
        "column1",
        "column2",
        modifier_indicator(F.col("cells")).alias("modifier_indicator"),
        "edit_kind",
        "source_file",
    )


def first_wins(candidates: DataFrame, key: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """P5: keep the first row per key by ``order`` (ties by ``payload``; nulls first).

    Repeats that differ in the last order column only are reduced to the first
    by a hash aggregate: its memory follows the different edits, not the rows.
    A minimum of structs sorts its rows, so it gets only what is left.
    """
    *leading, last = order
    firsts = candidates.groupBy(*key, *leading, *payload, F.col(last).isNull().alias("_unplaced")).agg(F.min(last).alias(last))
    first = F.min(F.struct(*[F.col(c) for c in order + payload])).alias("_first")
    agg = firsts.groupBy(*key).agg(first)
    return agg.select(*key, *[F.col(f"_first.{c}").alias(c) for c in order + payload])


def relevant_edits(raw: DataFrame, codes: list[str] = RELEVANT_CODES, group: tuple[str, ...] = ()) -> DataFrame:
    """Filter + dedupe on (column1, column2, kind), first in part, file and
    row order wins across all parts (of each group, such as a page). Ordinals
    are kept for later numbering."""
    cand = candidate_edits(raw, codes, group)
    return first_wins(
        cand,
        key=[*group, "column1", "column2", "edit_kind"],
        order=["part_ord", "file_ord", "row_ord"],
        payload=["modifier_indicator", "source_file"],
    ).select(*group, "part_ord", "file_ord", "row_ord", *EDIT_COLUMNS)


def combined_digest(parts: DataFrame, group_cols: list[str], ord_col: str = "part_ord", digest_col: str = "digest") -> DataFrame:
    """sha256 of the part digests concatenated in part order.

    The list per group holds one entry per downloaded part (a handful), so
    collecting it is bounded. Failed fetches must be filtered out by the
    caller; a group with no parts hashes the empty string.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(digest_col).alias("d"))))
    return parts.groupBy(*group_cols).agg(
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["d"]), ""), 256).alias("combined_sha256"),
        F.count(F.lit(1)).alias("part_count"),
    )


def scan_summary(edits: DataFrame, parts: DataFrame) -> DataFrame:
    """P6 count and S5 digest in one row: edits and parts are tagged, unioned
    and reduced in a single aggregation (the part list is a handful of rows)."""
    part = F.struct(F.col("part_ord").alias("o"), F.col("digest").alias("d"))
    rows = edits.select(F.lit(True).alias("_edit"), F.lit(None).cast("struct<o:int,d:string>").alias("_p")).unionByName(
        parts.select(F.lit(False).alias("_edit"), part.cast("struct<o:int,d:string>").alias("_p"))
    )
    ordered = F.array_sort(F.collect_list("_p"))
    return rows.agg(
        F.count_if(F.col("_edit")).alias("edit_count_relevant"),
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["d"]), ""), 256).alias("combined_sha256"),
        F.count(F.col("_p")).alias("part_count"),
    )
