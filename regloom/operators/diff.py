"""Compare a candidate rule matrix with the live one.

Plan: each side is indexed by rule_id with a partial aggregate (last
duplicate wins, D1), then ONE full outer join on rule_id yields added,
removed and changed rules together; field comparisons are null-safe column
expressions in the same projection. The result is a flat change table
(rule_id, change_type, path, old_value, new_value) that the summary and the
promotion decision read, so the join runs once.
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE_SCHEMA = "rule_id string, change_type string, path string, old_value string, new_value string"
_CHANGE_FIELDS = ["change_type", "path", "old_value", "new_value"]


def index_last(rules: DataFrame, ord_col: str = "rule_ord") -> DataFrame:
    """One row per rule_id; the last duplicate in matrix order wins."""
    cols = [c for c in rules.columns if c != "rule_id"]
    agg = rules.groupBy("rule_id").agg(F.max_by(F.struct(*cols), F.col(ord_col)).alias("_r"))
    return agg.select("rule_id", "_r.*")


def _change(change_type: str, path: str, old: Column, new: Column) -> Column:
    return F.struct(
        F.lit(change_type).alias("change_type"),
        F.lit(path).alias("path"),
        old.cast("string").alias("old_value"),
        new.cast("string").alias("new_value"),
    )


def _field_change(c: str) -> Column:
    """A scalar field: values_changed, or type_changes when one side is null."""
    o, n = F.col(f"_l.{c}"), F.col(f"_c.{c}")
    path = f"root['{c}']"
    return (
        F.when(o.eqNullSafe(n), F.lit(None))
        .when(o.isNull() | n.isNull(), _change("type_changes", path, o, n))
        .otherwise(_change("values_changed", path, o, n))
    )


PARAMS_ROOT = "root['params']"
_CHANGES_TYPE = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in _CHANGE_FIELDS]))


def _kind(v) -> str:
    return {bool: "bool", int: "int", Decimal: "float", str: "str", list: "list", dict: "dict"}.get(type(v), "none")


def _rendered(v) -> str:
    """Compact JSON with sorted keys; numbers as they were written."""
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_rendered(v[k])}" for k in sorted(v)) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_rendered, v)) + "]"
    return str(v) if isinstance(v, Decimal) else json.dumps(v, ensure_ascii=False)


def _identity(v) -> tuple:
    """Equal for equal values: lists as sets and objects without order, at every level."""
    if isinstance(v, dict):
        return "dict", frozenset((k, _identity(x)) for k, x in v.items())
    return ("list", frozenset(map(_identity, v))) if isinstance(v, list) else (_kind(v), v)


def params_changes(old: str | None, new: str | None) -> list[tuple]:
    """Change rows (change_type, path, old_value, new_value) between two JSON params texts.

    Objects are walked key by key to any depth; a list is one value, compared
    as a set whose items are compared the same way. Texts that are no JSON are
    compared as texts.
    """
    if old is None or new is None:
        return [] if old == new else [("dictionary_item_added" if old is None else "dictionary_item_removed", PARAMS_ROOT, old, new)]
    try:
        a, b = (json.loads(x, parse_float=Decimal) for x in (old, new))
    except ValueError:
        return [] if old == new else [("values_changed", PARAMS_ROOT, old, new)]
    out, todo = [], [(PARAMS_ROOT, a, b)]
    while todo:
        path, a, b = todo.pop()
        if isinstance(a, dict) and isinstance(b, dict):
            for k in sorted(a.keys() | b.keys(), reverse=True):
                step = f"{path}['{k}']"
                if k in a and k in b:
                    todo.append((step, a[k], b[k]))
                else:
                    out.append(("dictionary_item_removed", step, _rendered(a[k]), None) if k in a else ("dictionary_item_added", step, None, _rendered(b[k])))
        elif _kind(a) != _kind(b):
            out.append(("type_changes", path, _rendered(a), _rendered(b)))
        elif _identity(a) != _identity(b):
            out.append(("values_changed", path, _rendered(a), _rendered(b)))
    return sorted(out, key=lambda x: x[1])


@F.pandas_udf(_CHANGES_TYPE)
def _params_changes_udf(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(_CHANGE_FIELDS, c, strict=True)) for c in params_changes(a, b)] for a, b in zip(old, new, strict=True)])


def _params_changes(params_col: str) -> Column:
    """D3 for params: changes at any depth (absent object counts too).

    No built-in expression recurses as deep as the data, so texts that differ
    are walked in Arrow batches; equal ones go through as nulls.
    """
    o, n = F.col(f"_l.{params_col}"), F.col(f"_c.{params_col}")
    differ = ~o.eqNullSafe(n)
    return _params_changes_udf(F.when(differ, o), F.when(differ, n))


def diff_rules(
    live: DataFrame,
    candidate: DataFrame,
    compare_cols: Sequence[str],
    *,
    ord_col: str = "rule_ord",
    params_col: str | None = None,
) -> DataFrame:
    """The change table. ``source_key`` and anything not listed in
    ``compare_cols`` (generated_at, sources, schema_version) is ignored."""
    keep = [*compare_cols, *([params_col] if params_col else [])]
    L = index_last(live.select("rule_id", ord_col, *keep), ord_col).select("rule_id", F.struct(*keep).alias("_l"))
    C = index_last(candidate.select("rule_id", ord_col, *keep), ord_col).select("rule_id", F.struct(*keep).alias("_c"))
    j = L.join(C, "rule_id", "full_outer")
    fields = F.array(*[_field_change(c) for c in compare_cols])
    changes = F.filter(fields, lambda x: x.isNotNull())
    if params_col:
        changes = F.concat(changes, _params_changes(params_col))
    none = F.lit(None).cast("string")
    rows = (
        F.when(F.col("_l").isNull(), F.array(_change("rule_added", "root", none, none)))
        .when(F.col("_c").isNull(), F.array(_change("rule_removed", "root", none, none)))
        .otherwise(changes)
    )
    return j.select("rule_id", F.explode(rows).alias("_x")).select("rule_id", *[F.col(f"_x.{f}").alias(f) for f in _CHANGE_FIELDS])


def first_deploy(candidate: DataFrame, ord_col: str = "rule_ord") -> DataFrame:
    """No live matrix: every candidate id is added, in matrix order, duplicates kept."""
    return candidate.select(
        "rule_id",
        F.lit("rule_added").alias("change_type"),
        F.lit("root").alias("path"),
        F.lit(None).cast("string").alias("old_value"),
        F.lit(None).cast("string").alias("new_value"),
        F.col(ord_col),
    )


def summary(changes: DataFrame, *, first_deploy: bool = False) -> DataFrame:
    """Counts per kind and ``is_material`` (always true on first deploy)."""
    agg = changes.agg(
        F.count_if(F.col("change_type") == "rule_added").alias("added_count"),
        F.count_if(F.col("change_type") == "rule_removed").alias("removed_count"),
        F.count_distinct(F.when(~F.col("change_type").isin("rule_added", "rule_removed"), F.col("rule_id"))).alias("changed_count"),
    )
    material = F.lit(True) if first_deploy else (F.col("added_count") + F.col("removed_count") + F.col("changed_count") > 0)
    return agg.select("*", material.alias("is_material"))
