"""Sinks (S7, S10, S11, S12).

Results are written per run into ``run_id`` partitions with dynamic
partition overwrite, so a failed source in a later run never replaces an
earlier good result (history is kept). Every writer produces the usual
part-file layout; nothing is collected to the driver to be written.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_results(results: DataFrame, root: str, run_id: str) -> str:
    """Persist scrape results partitioned by run and source."""
    path = f"{root.rstrip('/')}/results"
    (
        results.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "source_key")
        .parquet(path)
    )
    return path


def read_results(spark: SparkSession, root: str, run_id: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Read persisted results back; a run filter prunes partitions. With a
    schema (of the results as written) nothing is inferred, also where a run has no result."""
    reader = spark.read if schema is None else spark.read.schema(StructType([*schema.fields, StructField("run_id", StringType())]))
    df = reader.parquet(f"{root.rstrip('/')}/results")
    return df.filter(F.col("run_id") == run_id) if run_id else df


def write_json(df: DataFrame, path: str) -> str:
    """Matrix, diff and chunk JSON (one JSON object per line)."""
    # Null fields are written too, so a column without any value is still there when read back.
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header, quotes doubled, nulls and empty texts both empty; an
    empty frame still writes its header, since the schema is explicit."""
    df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", nullValue="").csv(path)
    return path


def read_persisted_json(spark: SparkSession, root: str, skip_prefix: str = "engine1_matrix") -> DataFrame:
    """Every persisted JSON under ``root`` except matrix files."""
    df = spark.read.option("recursiveFileLookup", "true").json(root)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    parent = F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1)
    return df.filter(~name.startswith(skip_prefix) & ~parent.startswith(skip_prefix))
