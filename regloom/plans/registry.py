"""Registry of named queries: a Spark builder and, where SQL can say it, a
DuckDB oracle over the same parquet tables.

Builders take (spark, sf_dir) and return a lazy DataFrame over whole tables.
Column names and types are aligned with the oracle (computed columns are
aliased in both; sums are cast to BIGINT; dates are rendered as ISO strings).
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    covers: tuple[str, ...]  # SURVEY section 2 ids


_REGISTRY: dict[str, Query] = {}


def register(name: str, *, covers: tuple[str, ...], oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, oracle, covers)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from regloom.plans import (  # noqa: F401
        q_audit,
        q_chunks,
        q_diff,
        q_extract,
        q_handbooks,
        q_links,
        q_markup,
        q_matrix,
        q_ncci,
        q_ptp,
        q_reports,
        q_sinks,
    )

    return dict(_REGISTRY)
