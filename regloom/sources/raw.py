"""Landed raw payloads (S4, R3) read with the ``binaryFile`` source.

Layout: ``<root>/<source_key>/[<document>/]<sha256[:12]><suffix>``. Hashing runs in the
JVM (``sha2`` over the content column); size reports select only ``path`` and
``length`` so the file contents are never read for them.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def below(root: str, part: int) -> Column:
    """Of the path of a file under ``root``: 1 its source key, 2 the folders between ('' if none), 3 its name."""
    start = re.escape(re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root).rstrip("/"))
    return F.regexp_extract("path", f"{start}/([^/]+)/(?:(.+)/)?([^/]+)$", part)


def read_payloads(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per landed file with its sha256 and canonical raw name."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    sha = F.sha2(F.col("content"), 256)
    suffix = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    return df.select(
        below(root, 1).alias("source_key"),
        "path",
        "length",
        "content",
        sha.alias("content_sha256"),
        F.concat(F.substring(sha, 1, 12), suffix).alias("raw_name"),
    )


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """R3 input: (source_key, length) without reading contents."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return df.select(below(root, 1).alias("source_key"), "length")


def raw_bytes_per_source(spark: SparkSession, root: str) -> DataFrame:
    """Total bytes and file count per source (all files ever stored)."""
    from regloom.operators.report import raw_bytes

    return raw_bytes(file_sizes(spark, root))
