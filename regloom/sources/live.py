"""Live rules with a version pointer.

``<root>/live_rules/version=<v>`` holds one promoted matrix each and is written
whole before anything names it. ``<root>/live_pointer`` holds one row per
promotion (moved_at, version), appended as the last step by one committed
file: readers see the old version until that file is there, and a promotion
that fails on the way leaves the old one live. Reading opens the folder of the
live version alone. Promoting an earlier version again is moving the pointer
back.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

POINTER_SCHEMA = "moved_at timestamp, version string"


def _paths(root: str, version: str = "") -> tuple[str, str]:
    root = root.rstrip("/")
    return f"{root}/live_rules/version={version}", f"{root}/live_pointer"


def live_version(spark: SparkSession, root: str) -> str | None:
    """Version the pointer names (the last one it was moved to), or None before the first promotion."""
    try:
        moves = spark.read.schema(POINTER_SCHEMA).json(_paths(root)[1])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return moves.agg(F.max_by("version", F.struct("moved_at", "version")).alias("version")).first()["version"]


def read_live(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame | None:
    """Live rules, or None on first deploy."""
    version = live_version(spark, root)
    return None if version is None else spark.read.schema(schema).parquet(_paths(root, version)[0])


def write_version(rules: DataFrame, root: str, version: str) -> None:
    """Write a version's rules; nobody reads them before the pointer is moved."""
    rules.write.mode("overwrite").parquet(_paths(root, version)[0])


def move_pointer(spark: SparkSession, root: str, version: str) -> None:
    """Make a written version the live one."""
    spark.read.parquet(_paths(root, version)[0])  # an error here keeps the pointer where it is
    spark.range(1, numPartitions=1).select(F.current_timestamp().alias("moved_at"), F.lit(version).alias("version")).write.mode("append").json(_paths(root)[1])


def promote(rules: DataFrame, root: str, version: str) -> None:
    write_version(rules, root, version)
    move_pointer(rules.sparkSession, root, version)
