"""Queries of the training-data operators: name -> (builder, DuckDB SQL or None).

Each applies its operator with production parameters to its whole table.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import alignment, backoff, bpe, chat, kd_shards, line_join, order_minhash, packing, repetition, setsketch, spellings, token_count, token_files
from regloom.session import job_folder
from regloom.sources.tables import read_table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Tokens that fit a training sequence.
CONTEXT = 1024


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.token_counts(read_table(spark, sf_dir, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.neighbours(read_table(spark, sf_dir, "documents"))


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.scores(read_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(read_table(spark, sf_dir, "documents"), shards=24)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(turns.unionByName(tricky)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.report(read_table(spark, sf_dir, "documents"))


def op9_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read_table(spark, sf_dir, "documents"), setsketch.Rule(words=2, percent=80))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.report(read_table(spark, sf_dir, "documents"), min_words=1)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = job_folder(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), BYTE_BPE, folder)
    return token_files.digests(token_files.read(spark, folder))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_order_minhash": (op2_order_minhash, None),
    "op3_stupid_backoff": (op3_stupid_backoff, backoff.oracle()),
    "op4_kd_shards": (op4_kd_shards, None),
    "op5_bpe_round_trip": (op5_bpe_round_trip, None),
    "op6_packing": (op6_packing, None),
    "op7_chat_prefix_targets": (op7_chat_prefix_targets, None),
    "op8_quality_rules": (op8_quality_rules, None),
    "op9_setsketch_near_duplicates": (op9_setsketch_near_duplicates, None),
    "op10_line_dedup": (op10_line_dedup, None),
    "op11_token_files": (op11_token_files, None),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_spelling_variants": (op13_spelling_variants, None),
}
