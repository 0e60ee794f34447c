"""Contiguous 0-based numbering without a single-task window over the rows.

``row_number().over(Window.orderBy(...))`` without a partition moves every row
into one task. Here the order is made of levels: rows are numbered within
their fine key, fine keys within their coarse key, and coarse keys by a window
over one row each; a row's number is the sum of the three. The levels are the
leading columns of the order, with ordinals cut into runs (``run_of``), so
that a coarse key covers many fine keys and a fine key a bounded number of
rows, whatever a single result or table holds.

Everything is part of the caller's plan: nothing is written or computed while
it is built, and only keys and counts are shuffled besides the rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ordinals in a run.
RUN = 1 << 16


def run_of(ordinal: str | Column, width: int = RUN) -> Column:
    """The run that an ordinal belongs to; runs keep the ordinals' order."""
    c = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return F.floor(c / width)


def level_index(
    df: DataFrame, coarse: Sequence[str], fine: Sequence[str], order: Sequence[str], *, group: Sequence[str] = (), index_col: str = "idx"
) -> DataFrame:
    """Position of each row in the order of (coarse, fine, order) columns, within each group; the keys hold no nulls.

    Rows that tie in all of them get different positions in no fixed order.
    """
    group, coarse, fine = list(group), list(coarse), list(fine)
    keys = [*group, *coarse, *fine]
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    within = counts.withColumn("_fine", before(Window.partitionBy(*group, *coarse).orderBy(*fine)))
    totals = counts.groupBy(*group, *coarse).agg(F.sum("_n").alias("_n"))
    # One row per coarse key: the only window that may have a single task.
    offsets = totals.select(*group, *coarse, before(Window.partitionBy(*group).orderBy(*coarse)).alias("_coarse"))
    starts = within.join(offsets, [*group, *coarse]).select(*keys, (F.col("_coarse") + F.col("_fine")).alias("_start"))
    placed = df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return placed.join(starts, keys).withColumn(index_col, F.col("_start") + F.col("_place")).drop("_start", "_place")
