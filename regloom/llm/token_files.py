"""Operator 11: token ids as Parquet list columns that can be read selectively.

A folder holds two tables:

``ids``    one row per document in ascending key order: key, ``part`` (the
           writing task), ``at`` (ids before it within the part), ``n_tokens``
           and ``ids array<int>``. Ids are dictionary coded (a vocabulary's ids
           fit a dictionary page, so each takes log2(vocabulary) bits at most);
           the rising columns key, part and at are delta coded instead. Row
           groups and pages have set sizes and every file has page indexes, so
           a read of some keys or of a span of ids opens the row groups and
           pages that hold them, and a read of metadata no ids at all.
``parts``  one row per task: its first id's number, its ids and documents.

Ids are those of the tokenizers library with add_special_tokens=False, special
strings inside a text counting as one token.

Texts are put in key order with one range shuffle, encoded where they are
written, and never held together: a task's memory is one batch of texts. Rows
of one key (null keys, a hot key) are spread by the hash of their text and
their place in the input, so no key needs to fit a task. Part totals are
added up over one row per task.

Null text: the empty text (its end id alone). Null keys come first; rows that
share a key are ordered by their text's hash; repeated rows are written as
often as they occur. Only key and text are read, so other columns may have any
names. An empty table gives empty tables. A very long text is encoded in
pieces, its ids are one row.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regloom.llm import bpe, libraries

#: Bytes of a row group and of a page, and documents of a page of the narrow columns.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 64 << 10, 4096
#: The id after each document.
END_ID = 2


def _encoded(docs: DataFrame, path: str, text: str, key: str, end_id: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    names, end = [key, "part", "at", "n_tokens", "ids"], np.array([end_id], np.uint32)

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            done = 0
            for block in bpe.blocks(bpe.texts_of(b, text)):
                rows = list(libraries.encode_bytes(path, block))
                n = np.fromiter(map(len, rows), np.int64, len(rows)) + 1
                ends = np.concatenate(([0], np.cumsum(n)))
                ids = np.concatenate([x for r in rows for x in (r, end)]).view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                cols = [pa.array(np.full(len(n), part, np.int32)), pa.array(at + ends[:-1]), pa.array(n), lists]
                yield pa.RecordBatch.from_arrays([b.column(key).slice(done, len(n)), *cols], names=names)
                at, done = at + int(ends[-1]), done + len(n)

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, part int, at long, n_tokens long, ids array<int>")


def write(
    docs: DataFrame, path: str, folder: str, *, text: str = "text", key: str = "doc_id", end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
) -> None:
    """Encode every whole text with the vocabulary at ``path`` and write both tables under ``folder``."""
    order = [F.col(key).asc_nulls_first(), F.col("_tie"), F.col("_row")]
    tied = docs.select(key, text, F.xxhash64(text).alias("_tie"), F.monotonically_increasing_id().alias("_row"))
    ordered = tied.repartitionByRange(*order).sortWithinPartitions(*order)
    options = {
        "parquet.writer.version": "v2", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows,
        "parquet.dictionary.page.size": 1 << 20, "parquet.enable.dictionary": "true", **{f"parquet.enable.dictionary#{c}": "false" for c in (key, "part", "at")},
    }
    _encoded(ordered, path, text, key, end_id).write.options(**{k: str(v) for k, v in options.items()}).parquet(f"{folder}/ids")
    totals = docs.sparkSession.read.parquet(f"{folder}/ids").groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"), F.count(F.lit(1)).alias("documents"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"), "part_tokens", "documents").write.parquet(f"{folder}/parts")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (key, start, n_tokens, ids) of every document; ``start`` counts the ids of all documents before it.

    Columns that are not selected are not read, and conditions on the key reach the files.
    """
    ids, parts = spark.read.parquet(f"{folder}/ids"), spark.read.parquet(f"{folder}/parts")
    key = ids.columns[0]
    return ids.join(parts.select("part", "part_start"), "part").select(key, (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def read_span(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """Rows (key, start, ids) for the ids numbered first..last - 1 of the whole stream; documents are cut at both ends.

    Only parts that hold such ids are opened; the bounds of their numbers are one row on the driver.
    """
    parts = spark.read.parquet(f"{folder}/parts").where((F.col("part_start") < last) & (F.col("part_start") + F.col("part_tokens") > first))
    lo, hi = parts.agg(F.min("part"), F.max("part")).first()
    ids = spark.read.parquet(f"{folder}/ids").where(F.col("part").between(-1 if lo is None else lo, -1 if hi is None else hi))
    at = ids.join(parts, "part").withColumn("start", F.col("part_start") + F.col("at"))
    held = at.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    size = F.least(F.col("n_tokens"), F.lit(last) - F.col("start")) - skip
    return held.select(ids.columns[0], (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))


def digests(tokens: DataFrame) -> DataFrame:
    """Rows (key, start, n_tokens, ids_crc32) of a table as ``read`` returns it."""
    key = tokens.columns[0]

    def run(batches):
        for b in batches:
            lists = b.column("ids")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False).data.cast("B")
            crc = [zlib.crc32(flat[4 * i : 4 * j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (key, "start", "n_tokens")], pa.array(crc, pa.int64())], names=[key, "start", "n_tokens", "ids_crc32"])

    schema = StructType(tokens.schema.fields[:3]).add("ids_crc32", "long")
    return tokens.mapInArrow(run, schema)
