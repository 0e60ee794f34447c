"""Report tables (R1-R9) as aggregates and projections.

Everything is a narrow projection or a grouped aggregate; the only "top-k"
outputs (R8 samples, R9 first added ids) are sort+limit, which Spark runs as
a per-partition top-k followed by a small merge, never a full collect.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.sources.catalog import catalog_df

WARNINGS_CHARS = 300
PREVIEW_CHARS = 200
SAMPLE_CHARS = 400
SAMPLE_COUNT = 3
DIFF_ID_COUNT = 5
ELLIPSIS = "…"


def failed(warnings: Column) -> Column:
    """FAIL iff some warning contains 'scrape_failed'."""
    return F.exists(F.coalesce(warnings, F.array().cast("array<string>")), lambda w: w.contains("scrape_failed"))


def extracted(parsed_cols: dict[str, Column]) -> tuple[Column, Column]:
    """R2: (count, unit) by key presence: section_count > edit_count_relevant >
    g_codes_mentioned > candidate_links > (0, ''). A present 0 still wins.

    ``parsed_cols`` maps each of the four keys to a column that is null when
    the key is absent from the parsed facts.
    """
    sc = parsed_cols.get("section_count", F.lit(None))
    ec = parsed_cols.get("edit_count_relevant", F.lit(None))
    gc = parsed_cols.get("g_codes_mentioned", F.lit(None))
    cl = parsed_cols.get("candidate_links", F.lit(None))
    count = (
        F.when(sc.isNotNull(), sc.cast("bigint"))
        .when(ec.isNotNull(), ec.cast("bigint"))
        .when(gc.isNotNull(), F.size(gc).cast("bigint"))
        .when(cl.isNotNull(), F.size(cl).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    unit = (
        F.when(sc.isNotNull(), "sections")
        .when(ec.isNotNull(), "NCCI edits")
        .when(gc.isNotNull(), "G-codes mentioned")
        .when(cl.isNotNull(), "PDF links")
        .otherwise("")
    )
    return count, unit


def raw_bytes(files: DataFrame, key: str = "source_key") -> DataFrame:
    """Total bytes and file count per source over every stored file
    (partial aggregation; callers left-join and coalesce missing to 0)."""
    return files.groupBy(key).agg(
        F.sum("length").cast("bigint").alias("raw_bytes"), F.count(F.lit(1)).alias("raw_files")
    )


def run_summary(results: DataFrame, files: DataFrame | None, parsed_cols: dict[str, Column]) -> DataFrame:
    """R1 + R2 + R3: one row per result, ordered by its file name ('<key>.json').

    Sizes are summed per source of the catalog first, so they fit a broadcast
    and the results stay where they are."""
    count, unit = extracted(parsed_cols)
    base = results.select(
        "*",
        F.when(failed(F.col("warnings")), "FAIL").otherwise("OK").alias("status"),
        count.alias("extracted_count"),
        unit.alias("extracted_unit"),
        F.substring(F.array_join(F.coalesce(F.col("warnings"), F.array().cast("array<string>")), " | "), 1, WARNINGS_CHARS).alias("warnings_text"),
        F.concat(F.col("source_key"), F.lit(".json")).alias("file_name"),
    )
    if files is not None:
        known = F.broadcast(catalog_df(results.sparkSession).select(F.col("key").alias("source_key")))
        sizes = raw_bytes(files.join(known, "source_key", "left_semi"))  # a row per source of the catalog at most
        base = base.join(F.broadcast(sizes), "source_key", "left")
    else:
        base = base.withColumn("raw_bytes", F.lit(None).cast("bigint"))
    return base.withColumn("raw_bytes", F.coalesce(F.col("raw_bytes"), F.lit(0).cast("bigint")))


def python_json_style(js: Column) -> Column:
    """Compact JSON -> json.dumps default layout (', ' and ': ' separators).

    Escaped backslashes and quotes are set aside, then every second piece
    between quotes lies outside strings: plain replacements, linear in length.
    """
    back, quote = "\x01", "\x02"  # JSON text holds no bare control characters
    marked = F.replace(F.replace(js, F.lit("\\\\"), F.lit(back)), F.lit('\\"'), F.lit(quote))
    spaced = lambda x: F.replace(F.replace(x, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))
    pieces = F.transform(F.split(marked, '"'), lambda x, i: F.when(i % 2 == 0, spaced(x)).otherwise(x))
    return F.replace(F.replace(F.array_join(pieces, '"'), F.lit(quote), F.lit('\\"')), F.lit(back), F.lit("\\\\"))


def rules_flat(rules: DataFrame) -> DataFrame:
    """Null modifier -> '', params as JSON text, '{}' when absent."""
    return rules.select(
        "rule_ord",
        "rule_id",
        "payer_type",
        "code",
        F.coalesce(F.col("required_modifier"), F.lit("")).alias("required_modifier"),
        "logic_type",
        "source_key",
        F.coalesce(F.col("friendly_message"), F.lit("")).alias("friendly_message"),
        F.coalesce(python_json_style(F.col("params_json")), F.lit("{}")).alias("params_json"),
    )


def chunk_table(chunks: DataFrame) -> DataFrame:
    """200-char preview with newlines as spaces."""
    preview = F.replace(F.substring("text", 1, PREVIEW_CHARS), F.lit("\n"), F.lit(" "))
    keep = [c for c in chunks.columns if c != "text"]
    return chunks.select(*keep, preview.alias("preview"))


def totals(results: DataFrame, rules: DataFrame, chunks: DataFrame) -> DataFrame:
    """Ok / fail sources, rule and chunk counts (one row).

    ``chunks`` are rows of chunks, or of texts with their ``chunk_count``. The
    three inputs are tagged and unioned, then counted in ONE aggregation (no
    joins between single-row aggregates)."""
    many = F.col("chunk_count") if "chunk_count" in chunks.columns else F.lit(1)
    one = F.lit(1).cast("bigint").alias("_n")
    tagged = (
        results.select(F.when(failed(F.col("warnings")), F.lit("fail")).otherwise(F.lit("ok")).alias("_t"), one)
        .unionByName(rules.select(F.lit("rule").alias("_t"), one))
        .unionByName(chunks.select(F.lit("chunk").alias("_t"), many.cast("bigint").alias("_n")))
    )
    count = lambda t: F.coalesce(F.sum(F.when(F.col("_t") == t, F.col("_n"))), F.lit(0)).cast("bigint")
    return tagged.agg(count("ok").alias("ok"), count("fail").alias("fail"), count("rule").alias("rule_count"), count("chunk").alias("chunk_count"))


def chunks_per_source(chunks: DataFrame) -> DataFrame:
    """R7; ``chunks`` are rows of chunks, or of texts with their ``chunk_count`` (no text is cut to count)."""
    many = F.sum("chunk_count") if "chunk_count" in chunks.columns else F.count(F.lit(1))
    return chunks.groupBy("source_key").agg(many.cast("bigint").alias("chunk_count"))


def _sample(chunks: DataFrame, order: list[str]) -> DataFrame:
    t = F.col("text")
    cut = F.concat(F.substring(t, 1, SAMPLE_CHARS), F.when(F.length(t) > SAMPLE_CHARS, F.lit(ELLIPSIS)).otherwise(F.lit("")))
    return chunks.orderBy(*order).limit(SAMPLE_COUNT).select(*order, "source_key", "label", "char_count", cut.alias("sample"))


def chunk_samples(chunks: DataFrame, order: list[str]) -> DataFrame:
    """First three chunks in chunk order, text cut at 400 with an ellipsis."""
    return _sample(chunks, order)


def first_chunk_samples(units: DataFrame, unit_order: list[str], explode: Callable[[DataFrame], DataFrame], chunk_order: list[str]) -> DataFrame:
    """R8 from texts that give at least one chunk each: the first three chunks
    come from the first three texts, so only those are chunked (a top-k below
    the generator)."""
    return _sample(explode(units.orderBy(*unit_order).limit(SAMPLE_COUNT)), [*unit_order, *chunk_order])


def diff_overview(changes: DataFrame, order_col: str = "rule_id") -> DataFrame:
    """Change counts and the first five added ids: sorted ids normally,
    matrix order (``order_col="rule_ord"``) on a first deploy.

    The five ids come from a top-k (sort + limit 5); they are unioned with the
    change rows and everything is counted in one aggregation."""
    ct = F.col("change_type")
    top = (
        changes.filter(ct == "rule_added")
        .select("rule_id", F.col(order_col).alias("_o"))
        .orderBy("_o", "rule_id")
        .limit(DIFF_ID_COUNT)
        .select(F.lit(None).cast("string").alias("change_type"), "rule_id", F.struct("_o", "rule_id").alias("_top"))
    )
    rows = changes.select(
        "change_type", "rule_id", F.lit(None).cast(top.schema["_top"].dataType).alias("_top")
    ).unionByName(top)
    first = F.array_join(F.transform(F.array_sort(F.collect_list("_top")), lambda x: x["rule_id"]), ",")
    return rows.agg(
        F.count_if(ct == "rule_added").alias("added_count"),
        F.count_if(ct == "rule_removed").alias("removed_count"),
        F.count_distinct(F.when(ct.isNotNull() & ~ct.isin("rule_added", "rule_removed"), F.col("rule_id"))).alias("changed_count"),
        first.alias("first_added"),
    )
