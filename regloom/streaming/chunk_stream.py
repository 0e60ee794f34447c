"""Incremental chunking of newly landed text (ST1, with C8 kept as state).

``readStream`` over a folder of landed text (parquet) -> paragraph split and
windows (stateless, C1-C3) -> one row per chunk id ever seen: the ids live in
the state store (RocksDB: on disk with snapshots in the checkpoint folder, so
they may outgrow memory), partitioned by id, and a batch compares its chunks
with them alone. What was stored is never read again. Source files, state and
the file sink's log are committed together, so every file counts once and a
failed batch is repeated from the checkpoint without repeating its rows.

``trigger(availableNow=True)`` processes whatever landed since the last run
and stops, so a weekly schedule reruns it. Of equal chunks in one batch one is
kept; which one's place (doc_id, unit_ord, window_ord) it carries is not fixed,
since id, source, label and text are equal.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from regloom.operators import chunks as C

TEXT_SCHEMA = "doc_id bigint, source_key string, label string, text string"
PLACE_COLUMNS = ["doc_id", "unit_ord", "window_ord"]
#: Ids are kept on disk unless the session names a store of its own.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def new_chunks_of(texts: DataFrame) -> DataFrame:
    """Chunks of a stream of texts whose id no earlier row of the stream gave."""
    chunks = C.explode_windows(C.paragraph_units(texts)).select(*PLACE_COLUMNS, *C.CHUNK_COLUMNS)
    return chunks.dropDuplicates(["chunk_id"])


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that the session leaves unset, for the time of a query's start."""
    given = spark.sparkContext.getConf()
    ours = {k: v for k, v in wanted.items() if not given.contains(k)}
    before = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def landed_texts(spark: SparkSession, source_dir: str, schema: str | StructType = TEXT_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of landed text files; each landing batch may be its own folder of part files."""
    reader = spark.readStream.schema(schema).format("parquet").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def run_available(
    spark: SparkSession,
    source_dir: str,
    sink_path: str,
    checkpoint: str,
    schema: str | StructType = TEXT_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> None:
    """Process every text file landed since the last call, then stop."""
    write_new_chunks(landed_texts(spark, source_dir, schema, max_files_per_trigger), sink_path, checkpoint)


def write_new_chunks(texts: DataFrame, sink_path: str, checkpoint: str) -> None:
    """Append the new chunks of what a stream of texts holds now."""
    with _settings(texts.sparkSession, STATE_STORE):
        query = (
            new_chunks_of(texts).writeStream.format("parquet").outputMode("append").option("path", sink_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
