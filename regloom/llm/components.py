"""Connected components of links by alternating star contraction.

Each round every node hands its larger neighbours to its smallest one (large
star) and its smaller neighbours too (small star), until all links point to
the smallest node of their component. Each step's table is written to the
shared folder, so a lost executor rereads it; nothing but one flag per round
reaches the driver, and joins on a node of very many links have
an exchange on both sides that AQE can split.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.session import written


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two links downwards, or one to a node that has one itself."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return bool(several.unionByName(chained).take(1))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): the smallest node reachable, for every node of a link other than the smallest itself.

    Links whose ends are equal or null add nothing; repeated links count once.
    """
    edges = written(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while _unfinished(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "star")
        large = written(both.where("v > u").join(least, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "star")
        least = written(large.groupBy("u").agg(F.min("v").alias("low")), "star")
        small = large.join(least, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("low").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
