"""Contiguous numbering without a global window equals row_number - 1."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regloom.functions.numbering import level_index, run_of


@pytest.mark.parametrize("width", [1, 7, 1000, 10**6])
def test_matches_row_number(spark, width):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 50).alias("o"), F.col("id"))
    keyed = df.withColumns({"r": run_of("o", 5), "e": run_of("id", width)})
    w = Window.partitionBy("g").orderBy("o", "id")
    want = sorted(tuple(r) for r in df.withColumn("idx", F.row_number().over(w) - 1).collect())
    got = level_index(keyed, ["r"], ["o", "e"], ["id"], group=["g"]).select("g", "o", "id", "idx")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_one_group_and_gaps_between_ordinals(spark):
    df = spark.range(0, 1000).select((F.col("id") * 999_983).alias("k"))
    got = {r.k: r.idx for r in level_index(df.withColumn("r", run_of("k")), ["r"], ["k"], ["k"]).collect()}
    assert got == {i * 999_983: i for i in range(1000)}


def test_ties_get_numbers_of_their_own(spark):
    df = spark.createDataFrame([(0, 1)] * 5 + [(0, 0), (3, 9), (3, 9)], "a int, b int")
    rows = level_index(df, ["a"], ["b"], ["b"]).collect()
    assert sorted(r.idx for r in rows) == list(range(8))
    assert {r.idx for r in rows if r.b == 1} == {1, 2, 3, 4, 5} and {r.idx for r in rows if r.a == 3} == {6, 7}


def test_nothing_is_written_or_run_while_a_plan_is_made(spark):
    never = spark.range(3).select(F.raise_error(F.lit("ran")).cast("bigint").alias("k"))
    level_index(never.withColumn("r", run_of("k")), ["r"], ["k"], ["k"])
    none = spark.range(0).select(F.col("id").alias("k"), run_of("id").alias("r"))
    assert level_index(none, ["r"], ["k"], ["k"]).count() == 0
