"""Index of known chunk ids (C8): ids only, bucketed by id.

``<root>/chunk_ids`` holds (chunk_id, run_id) in ``BUCKETS`` buckets. A run joins its
chunks with it bucket by bucket: the stored side is read without texts and
without an exchange, however many runs it holds. The table's definition is
kept in the session's catalog only while a plan is made; the files under the
root are what lasts.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the index; fixed for the life of a root, so choose it for the ids expected.
BUCKETS = 64


@contextmanager
def _table(spark: SparkSession, root: str, buckets: int) -> Iterator[str]:
    """The index as a table of this session (made if its files do not exist yet)."""
    name = f"chunk_ids_{uuid.uuid4().hex}"
    place = f"{root.rstrip('/')}/chunk_ids".replace("'", "''")
    spark.sql(
        f"CREATE TABLE {name} (chunk_id STRING, run_id STRING) USING parquet "
        f"CLUSTERED BY (chunk_id) SORTED BY (chunk_id) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")  # the definition alone: the location is ours, the files stay


def known_ids(spark: SparkSession, root: str, *, before: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Stored ids (chunk_id); without those that run ``before`` itself stored, so that a repeated run finds the same ids new."""
    with _table(spark, root, buckets) as name:
        stored = spark.table(name)
        return (stored if before is None else stored.where(F.col("run_id") != before)).select("chunk_id")


def new_chunks(chunks: DataFrame, root: str, run_id: str, *, buckets: int = BUCKETS) -> DataFrame:
    """Chunks whose id no earlier run stored."""
    return chunks.join(known_ids(chunks.sparkSession, root, before=run_id, buckets=buckets), "chunk_id", "left_anti")


def add_ids(chunks: DataFrame, root: str, run_id: str, *, buckets: int = BUCKETS) -> None:
    """Store the ids of a run's new chunks (after the chunks themselves are written: an id is known only when its chunk is)."""
    spark = chunks.sparkSession
    ids = chunks.select("chunk_id").distinct().withColumn("run_id", F.lit(run_id)).repartition(buckets, "chunk_id")
    with _table(spark, root, buckets) as name:
        ids.write.insertInto(name)
