"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what one stage
writes is read as the next one's documents. All but the last keep the columns
of documents. ``run`` applies them in order, with every result written once
to the shared checkpoint folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import line_join, packing, repetition, setsketch
from regloom.llm.queries import BYTE_BPE
from regloom.session import ensure_defaults, written
from regloom.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a repetition limit rejects go; so do null, empty and very short texts.

    Every row is judged by its own text: keys don't matter, repeated rows stay
    or go together, all columns are kept as they are. No rows give none.
    """
    ensure_defaults(spark)
    return repetition.keep_clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one leave the texts; texts left without a word go, n_chars follows the text.

    Earlier means by key, then line, then the text's hash; null keys come
    first. Rows that share key and text are one document and keep the same
    lines; rows that share a key, or have none, but differ in text are
    different ones. Other columns are kept as they are. No rows give none.
    """
    ensure_defaults(spark)
    return line_join.drop_lines(docs, min_words=1).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays, the one with the smallest key.

    A document is a key with its text: rows that share a key but not a text are
    judged apart, and rows without a key stand behind all others (ties by the
    text's hash), so of copies without a key one text stays. Rows that share key
    and text are one document and stay or go together. Texts without a word are
    nobody's copies. All columns are kept as they are. No rows give none.
    """
    ensure_defaults(spark)
    name = F.struct(F.col("doc_id").isNull().alias("keyless"), "doc_id", F.xxhash64("text").alias("text"))
    named = docs.withColumn("_document", name)
    found = setsketch.near_duplicates(named, setsketch.Rule(words=5, percent=80), key="_document")
    copies = found.where("not kept").select("_document").distinct()
    return named.join(copies, "_document", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in training sequences; repeated rows are packed as often as they occur, null texts as empty ones."""
    ensure_defaults(spark)
    return packing.pack(docs, BYTE_BPE)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", pack)]

#: SQL can't express tokenizing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
