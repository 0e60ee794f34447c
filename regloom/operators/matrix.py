"""Rule matrix (M1-M20): results x templates -> ordered, versioned rules.

Input ``results`` (one row per scrape result):
  result_ord, source_key, source_name, fetched_at, content_sha256,
  warnings ARRAY<STRING>, parsed_empty BOOLEAN, plus any fact columns of
  templates.FACT_TYPES (missing ones are treated as absent).
Input ``edits`` (optional, NCCI): source_key, result_ord, edit_ord, column1, column2.

Plan: the guard (M3) is a narrow filter; the template table (19 fixed rows)
is broadcast into the results, so building rules is a map-side join; the
only wide step is the final numbering (M4), done by levels of ordinals rather
than a single-task window.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.functions.numbering import level_index, run_of
from regloom.operators.templates import (
    FACT_TYPES,
    FEDERAL_KEYS,
    NCCI_KEYS,
    NCCI_MESSAGE,
    RULE_SCHEMA_VERSION,
    TEMPLATES,
    Expr,
    Template,
)

RULE_COLUMNS = [
    "rule_id",
    "payer_type",
    "code",
    "required_modifier",
    "logic_type",
    "source_key",
    "friendly_message",
    "params_json",
]
#: Results whose rules are numbered together.
RESULT_RUN = 4096
_JSON_OPTS = {"ignoreNullFields": "false"}


# ------------------------------------------------------------ rendering
def _lit_value(v) -> Column:
    if isinstance(v, Expr):
        return F.expr(v.spark)
    if isinstance(v, bool) or isinstance(v, (int, str)):
        return F.lit(v)
    if isinstance(v, list):
        return F.array(*[F.lit(x) for x in v]) if v else F.array().cast("array<string>")
    if isinstance(v, dict):
        return F.create_map(*[c for k, x in v.items() for c in (F.lit(k), F.lit(x))])
    raise TypeError(f"unsupported param value {v!r}")


def params_column(t: Template) -> Column:
    """Params as compact JSON in template key order; null when there are none."""
    if not t.params:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[_lit_value(v).alias(k) for k, v in t.params]), _JSON_OPTS)


def message_column(t: Template) -> Column:
    if not t.message_args:
        return F.lit(t.message)
    return F.format_string(t.message, *[F.expr(a.spark) for a in t.message_args])


def condition_column(t: Template) -> Column:
    return F.expr(t.condition.spark) if t.condition else F.lit(True)


def _switch(key: Column, branches: list[tuple[str, Column]]) -> Column:
    out = None
    for k, c in branches:
        out = F.when(key == k, c) if out is None else out.when(key == k, c)
    return out


def template_table(spark: SparkSession) -> DataFrame:
    rows = [
        (t.source_key, t.template_ord, t.rule_id, t.payer_type, t.code, t.required_modifier, t.logic_type)
        for t in TEMPLATES
    ]
    schema = "source_key string, template_ord int, rule_id string, payer_type string, code string, required_modifier string, logic_type string"
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------- building
def ensure_facts(results: DataFrame) -> DataFrame:
    """Add absent fact columns as typed nulls (absent key -> template default)."""
    missing = [F.lit(None).cast(t).alias(c) for c, t in FACT_TYPES.items() if c not in results.columns]
    return results.select("*", *missing) if missing else results


def guard(results: DataFrame) -> DataFrame:
    """M3: drop results with a warning containing 'scrape_failed' or empty parsed facts."""
    failed = F.exists(F.coalesce(F.col("warnings"), F.array().cast("array<string>")), lambda w: w.contains("scrape_failed"))
    return results.filter(~failed & ~F.coalesce(F.col("parsed_empty"), F.lit(False)))


def template_rules(results: DataFrame, max_h_codes: int | None = None) -> DataFrame:
    """M1, M2, M7-M10, M12-M19 for the results that pass the guard; ``max_h_codes`` bounds R-SUNSHINE-01's scope."""
    spark = results.sparkSession
    usable = ensure_facts(guard(results))
    if max_h_codes is not None:
        usable = usable.withColumn("h_codes_referenced", F.slice("h_codes_referenced", 1, max_h_codes))
    joined = usable.join(F.broadcast(template_table(spark)), "source_key")
    rid = F.col("rule_id")
    message = _switch(rid, [(t.rule_id, message_column(t)) for t in TEMPLATES])
    params = _switch(rid, [(t.rule_id, params_column(t)) for t in TEMPLATES])
    keep = _switch(rid, [(t.rule_id, condition_column(t)) for t in TEMPLATES])
    return joined.filter(keep).select(
        "result_ord",
        "template_ord",
        F.lit(0).cast("bigint").alias("edit_ord"),
        *[c for c in RULE_COLUMNS if c not in ("friendly_message", "params_json")],
        message.alias("friendly_message"),
        params.alias("params_json"),
    ).select("result_ord", "template_ord", "edit_ord", *RULE_COLUMNS)


def ncci_rules(results: DataFrame, edits: DataFrame) -> DataFrame:
    """One BundleGuard rule per edit; ids R-NCCI-%04d / R-NCCIMCD-%04d from 0.

    ``edit_ord`` is the edit's 0-based position in its table (see
    ``number_edits``); ``format_string`` keeps five-digit positions whole.
    """
    usable = guard(results).filter(F.col("source_key").isin(list(NCCI_KEYS))).select("source_key", "result_ord")
    e = edits.join(usable, ["source_key", "result_ord"], "left_semi")
    k = F.col("source_key")
    prefix = _switch(k, [(key, F.lit(p)) for key, (p, _) in NCCI_KEYS.items()])
    payer = _switch(k, [(key, F.lit(pay)) for key, (_, pay) in NCCI_KEYS.items()])
    return e.select(
        "result_ord",
        F.lit(0).alias("template_ord"),
        F.col("edit_ord").cast("bigint").alias("edit_ord"),
        F.format_string("%s-%04d", prefix, F.col("edit_ord")).alias("rule_id"),
        payer.alias("payer_type"),
        F.col("column1").alias("code"),
        F.lit(None).cast("string").alias("required_modifier"),
        F.lit("BundleGuard").alias("logic_type"),
        k.alias("source_key"),
        F.format_string(NCCI_MESSAGE, F.col("column1"), F.col("column2")).alias("friendly_message"),
        F.to_json(F.struct(F.col("column2").alias("mutually_exclusive_with")), _JSON_OPTS).alias("params_json"),
    )


def number_edits(edits: DataFrame, scope: list[str] = ["source_key", "result_ord"]) -> DataFrame:
    """Positions of deduplicated edits in first-seen order within each table."""
    keyed = edits.withColumn("_run", run_of("row_ord"))
    return level_index(keyed, ["part_ord", "file_ord"], ["_run"], ["row_ord"], group=scope, index_col="edit_ord").drop("_run")


def check_messages(rules: DataFrame) -> DataFrame:
    """M1: a blank friendly_message fails the job (assert_true, no collect)."""
    ok = F.assert_true(F.trim(F.coalesce(F.col("friendly_message"), F.lit(""))) != "", F.concat(F.col("rule_id"), F.lit(": friendly_message is required")))
    # The check is folded into the message column so column pruning keeps it.
    return rules.withColumn("friendly_message", F.coalesce(ok.cast("string"), F.col("friendly_message")))


def build_rules(results: DataFrame, edits: DataFrame | None = None, *, numbered: bool = True, max_h_codes: int | None = None) -> DataFrame:
    """M4: federal first, then input order, then builder order, then edit order.

    Output: rule_ord (0-based, contiguous) + RULE_COLUMNS. ``numbered=False``
    skips the numbering for callers that only count or group the rules.
    """
    rules = template_rules(results, max_h_codes)
    if edits is not None:
        rules = rules.unionByName(ncci_rules(results, edits))
    rules = check_messages(rules)
    if not numbered:
        return rules.select(*RULE_COLUMNS)
    bucket = F.when(F.col("source_key").isin(FEDERAL_KEYS), F.lit(0)).otherwise(F.lit(1)).alias("bucket")
    # A run covers many results, and a result's edits come in runs of their own.
    staged = rules.select(bucket, run_of("result_ord", RESULT_RUN).alias("_results"), run_of("edit_ord").alias("_edits"), "*")
    numbered = level_index(staged, ["bucket", "_results"], ["result_ord", "_edits"], ["template_ord", "edit_ord"], index_col="rule_ord")
    return numbered.select("rule_ord", *RULE_COLUMNS)


def provenance(results: DataFrame) -> DataFrame:
    """M5: (source_key, sha, fetched_at) of each used source in input order,
    also when it gave zero rules."""
    from regloom.operators.templates import BUILDER_KEYS

    used = guard(results).filter(F.col("source_key").isin(BUILDER_KEYS))
    return used.select("result_ord", "source_key", "content_sha256", "fetched_at")


def header(rules: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """M6: one row: schema_version, generated_at, rule_count."""
    ts = generated_at if generated_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return rules.agg(F.count(F.lit(1)).alias("rule_count")).select(
        F.lit(RULE_SCHEMA_VERSION).alias("schema_version"), ts.alias("generated_at"), "rule_count"
    )


# ---------------------------------------------------------- DuckDB oracle
def _duck_lit(v) -> str:
    if isinstance(v, Expr):
        return v.for_duck()
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, list):
        return "[" + ", ".join(_duck_lit(x) for x in v) + "]::varchar[]" if v else "[]::varchar[]"
    if isinstance(v, dict):
        return "json_object(" + ", ".join(f"{_duck_lit(k)}, {_duck_lit(x)}" for k, x in v.items()) + ")"
    raise TypeError(v)


def duck_template_sql(facts: str) -> str:
    """UNION ALL of one SELECT per template over the ``facts`` relation.

    ``facts`` must expose result_ord, source_key, failed, parsed_empty and the
    fact columns it uses.
    """
    parts = []
    for t in TEMPLATES:
        msg = "'" + t.message.replace("'", "''") + "'"
        if t.message_args:
            msg = f"printf({msg}, {', '.join(a.for_duck() for a in t.message_args)})"
        if t.params:
            params = "cast(json_object(" + ", ".join(f"'{k}', {_duck_lit(v)}" for k, v in t.params) + ") as varchar)"
        else:
            params = "cast(null as varchar)"
        cond = t.condition.for_duck() if t.condition else "true"
        rm = "null" if t.required_modifier is None else f"'{t.required_modifier}'"
        parts.append(
            f"select result_ord, {t.template_ord} as template_ord, cast(0 as bigint) as edit_ord, "
            f"'{t.rule_id}' as rule_id, '{t.payer_type}' as payer_type, '{t.code}' as code, "
            f"cast({rm} as varchar) as required_modifier, '{t.logic_type}' as logic_type, source_key, "
            f"{msg} as friendly_message, {params} as params_json "
            f"from {facts} where source_key = '{t.source_key}' and not failed and not parsed_empty and ({cond})"
        )
    return "\nunion all\n".join(parts)


def federal_sql_list() -> str:
    return ", ".join(f"'{k}'" for k in FEDERAL_KEYS)
