"""Overlapping text chunks with content-hash ids.

All of it is narrow: ``split``/``posexplode`` and ``explode(sequence(...))`` run
per row inside the scan stage, so chunking 100 TB of text is a map-only job
whose output partitions follow the input splits. The only shuffle is the
optional left-anti join against already-known chunk ids (C8).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.regex import PY_SPACE, pattern, py_strip

# Fixed values of the reference chunker: window size and overlap in characters.
DEFAULT_CHUNK_CHARS = 1200
DEFAULT_OVERLAP_CHARS = 150

#: Windows of a text from which on it is cut into strides first.
LONG_TEXT_WINDOWS = 8

CHUNK_COLUMNS = ["chunk_id", "source_key", "label", "text", "char_count"]


def _check_window(size: int, overlap: int) -> int:
    # overlap >= size never advances (the reference loops forever); refuse it.
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size={size} overlap={overlap}")
    return size - overlap


def chunk_id(source_key: Column, label: Column, piece: Column) -> Column:
    """First 16 hex digits of sha256('source|label|piece').

    ``concat_ws`` would drop nulls, so every part is coalesced first.
    """
    parts = [F.coalesce(c, F.lit("")) for c in (source_key, label, piece)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def split_paragraphs(text: Column) -> Column:
    """``re.split(r"\\n\\s*\\n", text.strip())``, each stripped, blanks dropped."""
    parts = F.split(py_strip(F.coalesce(text, F.lit(""))), pattern(rf"\n{PY_SPACE}*\n"))
    return F.filter(F.transform(parts, py_strip), lambda p: p != F.lit(""))


def window_count(length: Column, size: int, stride: int) -> Column:
    """Number of windows: 1 for texts up to ``size`` (also when empty)."""
    extra = F.ceil((length - F.lit(size)) / F.lit(stride))
    return F.greatest(F.lit(0), extra).cast("int") + F.lit(1)


def chunk_counts(length: Column, size: int = DEFAULT_CHUNK_CHARS, overlap: int = DEFAULT_OVERLAP_CHARS) -> Column:
    """Chunks of a text of so many characters, without cutting it (null: the empty text)."""
    return window_count(F.coalesce(length, F.lit(0)), size, _check_window(size, overlap))


def explode_windows(
    units: DataFrame,
    *,
    text_col: str = "text",
    size: int = DEFAULT_CHUNK_CHARS,
    overlap: int = DEFAULT_OVERLAP_CHARS,
    window_ord_col: str = "window_ord",
) -> DataFrame:
    """C2 + C3: one row per window of ``text_col``; other columns pass through.

    Window i covers characters [i*stride, i*stride+size); the last one ends at
    the text end. Expects ``source_key`` and ``label`` columns for the id.
    """
    stride = _check_window(size, overlap)
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(text)
    keep = [c for c in units.columns if c != text_col]
    # The pieces are cut inside one array expression, so exploded rows carry
    # only their own piece, never the whole document.
    starts = F.sequence(F.lit(0), window_count(n, size, stride) - 1)
    pieces = F.transform(starts, lambda i: F.substring(text, i * F.lit(stride) + F.lit(1), F.lit(size)))
    # Characters are found by counting from the text's start, which many windows
    # of one text would do over and over: long texts are cut into strides once,
    # and a window is put together from its own stride and those it reaches into.
    strides = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    reach = 1 + -(-overlap // stride)
    windows = lambda cut: F.transform(starts, lambda i: F.substring(F.array_join(F.slice(cut, i + 1, reach), ""), 1, size))
    long_pieces = F.get(F.transform(F.array(strides), windows), 0)
    pieces = F.when(n > LONG_TEXT_WINDOWS * stride, long_pieces).otherwise(pieces)
    exploded = units.select(*keep, F.posexplode(pieces).alias(window_ord_col, "text"))
    return exploded.select(
        *keep,
        F.col(window_ord_col),
        chunk_id(F.col("source_key"), F.col("label"), F.col("text")).alias("chunk_id"),
        F.col("text"),
        F.length("text").alias("char_count"),
    )


def paragraph_units(df: DataFrame, *, text_col: str = "text", unit_ord_col: str = "unit_ord") -> DataFrame:
    """C1 as rows: one row per non-blank paragraph with its position."""
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(split_paragraphs(F.col(text_col))).alias(unit_ord_col, text_col))


def chunk_for_rag(
    results: DataFrame,
    *,
    size: int = DEFAULT_CHUNK_CHARS,
    overlap: int = DEFAULT_OVERLAP_CHARS,
) -> DataFrame:
    """Section route when ``sections`` is non-empty, free-text route otherwise.

    ``results`` columns: result_ord, source_key, source_name, sections
    (ARRAY<STRUCT<id,label,text>>, may be null), full_text, raw_excerpt.
    Both routes build the same ARRAY<STRUCT<label,text>> in one projection,
    so the input is scanned once and exploded once. Output carries
    (result_ord, unit_ord, window_ord) so order is explicit.
    """
    has_sections = F.coalesce(F.size("sections") > 0, F.lit(False))
    sec_units = F.transform(
        "sections",
        lambda s: F.struct(
            F.concat(F.coalesce(s["id"], F.lit("?")), F.lit(" "), F.coalesce(s["label"], F.lit(""))).alias("label"),
            F.coalesce(s["text"], F.lit("")).alias("text"),
        ),
    )
    body = F.coalesce(F.nullif(F.col("full_text"), F.lit("")), F.nullif(F.col("raw_excerpt"), F.lit("")), F.lit(""))
    free_units = F.transform(
        split_paragraphs(body), lambda p: F.struct(F.col("source_name").alias("label"), p.alias("text"))
    )
    units = results.select(
        "result_ord",
        "source_key",
        F.posexplode(F.when(has_sections, sec_units).otherwise(free_units)).alias("unit_ord", "u"),
    ).select("result_ord", "source_key", "unit_ord", F.col("u.label").alias("label"), F.col("u.text").alias("text"))
    out = explode_windows(units, size=size, overlap=overlap)
    return out.select("result_ord", "unit_ord", "window_ord", *CHUNK_COLUMNS)


def route_engine2(results: DataFrame, catalog: DataFrame) -> DataFrame:
    """Only engine-2 sources are chunked (semi join with the catalog).

    The catalog is a fixed 32-row table, so broadcasting it is size-safe.
    """
    e2 = catalog.filter(F.col("engine") == "engine2").select(F.col("key").alias("source_key"))
    return results.join(F.broadcast(e2), "source_key", "left_semi")


def new_chunks(chunks: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Chunks whose id is not yet embedded (left-anti on chunk_id).

    Both sides are keyed by a uniformly distributed hash, so the shuffle is
    balanced; AQE turns it into a broadcast when the known set is small.
    """
    known = known_ids.select("chunk_id").distinct()
    return chunks.join(known, "chunk_id", "left_anti")
