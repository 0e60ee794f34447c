"""Reader for procedure-to-procedure (PTP) edit files.

Tab-delimited latin-1 text files are read into the raw-row shape of
``regloom.operators.ptp``: part_ord, file_ord, member, sheet, row_ord, cells
ARRAY<STRING>. Archives and workbooks are unpacked before they land (their
decoding is no Spark work); workbook rows arrive as tables with a ``sheet``.

A quoted cell may hold line ends, so a line alone does not tell whether it
starts a record. Files are split into blocks all the same, one task each:

1. every line with a quote is a function of one bit (is a quoted cell open
   before it? after it?), and the functions of a block's lines, composed in
   order, are the block's function;
2. the functions of a file's blocks, composed in order, tell for every block
   whether it starts inside a quoted cell (a window over one row per block);
3. with that bit each task assembles its block's records. A record that
   crosses a block's end is put together from its pieces, at most two a block;
   only blocks with such an end are read again for it.

So the text is scanned for the quotes and once more for the records, and a
single large file uses as many tasks as it has blocks.
"""
from __future__ import annotations

import csv

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: States of a reader between two quotes: at a field's start, in an unquoted field, in a quoted one, after a quote in a quoted one.
START, PLAIN, QUOTED, CLOSING = range(4)


def file_name(path: Column) -> Column:
    """Last step of a file URI, with its percent-encoding undone."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def ends_open(line: Column, opened: bool) -> Column:
    """Whether a quoted cell is open at the line's end, given whether one is at its start.

    The line is taken quote by quote with the text before each: a quote opens
    a cell only at a field's start, two in a row inside a cell are one
    character, and what follows a closed cell up to the next tab is plain.
    """
    pieces = F.split(line, '"')

    def step(state: Column, before: Column) -> Column:
        at_start = before.endswith("\t") | ((state == START) & (before == ""))
        doubled = (state == CLOSING) & (before == "")
        return F.when(state == QUOTED, CLOSING).when(doubled | at_start, QUOTED).otherwise(PLAIN)

    return F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), F.lit(QUOTED if opened else START), step) == QUOTED


def _ends_open(line: str, opened: bool) -> bool:
    """``ends_open`` for one line."""
    state = QUOTED if opened else START
    for before in line.split('"')[:-1]:
        if state == QUOTED:
            state = CLOSING
        elif before.endswith("\t") or (before == "" and state in (START, CLOSING)):
            state = QUOTED
        else:
            state = PLAIN
    return state == QUOTED


def _lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Lines of all files in order within their block; lines end as in universal newlines."""
    text = spark.read.text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_starts(lines: DataFrame) -> DataFrame:
    """Rows (file, block, opened, open_end): whether a quoted cell is open where the block starts and ends."""
    quoted = F.col("value").contains('"')
    entry = F.struct(F.monotonically_increasing_id().alias("at"), ends_open(F.col("value"), False).alias("f0"), ends_open(F.col("value"), True).alias("f1"))
    # A block's quoted lines are fewer than its bytes, so its list is bounded by the block's size.
    per_block = lines.select("file", "block", F.when(quoted, entry).alias("q")).groupBy("file", "block").agg(F.array_sort(F.collect_list("q")).alias("q"))
    through = lambda start: F.aggregate("q", F.lit(start), lambda s, x: F.when(s, x["f1"]).otherwise(x["f0"]))
    functions = per_block.select("file", "block", through(False).alias("f0"), through(True).alias("f1"))
    # State after a block: the last block that fixes it whatever came before, turned over by those since that swap it.
    in_file = Window.partitionBy("file").orderBy("block")
    fixes = F.col("f0") == F.col("f1")
    spans = functions.withColumn("span", F.sum(F.when(fixes, 1).otherwise(0)).over(in_file))
    in_span = Window.partitionBy("file", "span").orderBy("block")
    swaps = F.sum(F.when(F.col("f0") & ~F.col("f1"), 1).otherwise(0)).over(in_span)
    fixed = F.first(F.when(F.col("span") > 0, F.col("f0")).otherwise(False)).over(in_span)
    after = spans.withColumn("open_end", fixed != (swaps % 2 == 1))
    return after.select("file", "block", F.coalesce(F.lag("open_end").over(in_file), F.lit(False)).alias("opened"), "open_end")


def _cells(lines: list[str]) -> list[str]:
    """One record's cells."""
    if len(lines) == 1 and '"' not in lines[0]:
        return lines[0].split("\t") if lines[0] else []
    csv.field_size_limit(1 << 31)
    rows = list(csv.reader([x + "\n" for x in lines[:-1]] + [lines[-1]], delimiter="\t"))
    return rows[0] if rows else []


def _walk(batches):
    """(file, row_ord, block, kind, lines) of records in block order: WHOLE ones, the REST of one begun before, the BEGUN one at the end.

    ``row_ord`` is the block's first byte plus the line's number, which rises
    through the file because every line has a byte of its own.
    """
    here, held, at, begun, opened = None, [], 0, 0, False
    for b in batches:
        texts = [x.decode("latin-1") for x in b.column("body").to_pylist()]
        for file, block, start, line in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("opened").to_pylist(), texts, strict=True):
            if (file, block) != here:
                if held:
                    yield *here, REST if begun < 0 else BEGUN, begun, held
                here, held, at, opened = (file, block), [], 0, start
                begun = -1 if start else 0
            if not opened:
                begun = at
            if '"' in line:
                opened = _ends_open(line, opened)
            held.append(line)
            at += 1
            if not opened:
                yield *here, REST if begun < 0 else WHOLE, begun, held
                held = []
    if held:
        yield *here, REST if begun < 0 else BEGUN, begun, held


WHOLE, REST, BEGUN = range(3)
ROWS_AT_ONCE = 4096


def _batches(rows, make, names):
    some = []
    for r in rows:
        some.append(make(*r))
        if len(some) == ROWS_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some, strict=True)], names=names)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some, strict=True)], names=names)


def _whole_records(batches):
    rows = ((f, b, n, x) for f, b, kind, n, x in _walk(batches) if kind == WHOLE)
    yield from _batches(rows, lambda f, b, n, x: (f, b + n, _cells(x)), ["file", "row_ord", "cells"])


def _pieces(batches):
    rows = (r for r in _walk(batches) if r[2] != WHOLE)
    yield from _batches(rows, lambda f, b, kind, n, x: (f, b, kind, b + max(n, 0), "\n".join(x)), ["file", "block", "kind", "row_ord", "text"])


def _joined_records(batches):
    for b in batches:
        cells = pa.array([_cells(x.split("\n")) for x in b.column("text").to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("row_ord"), cells], names=["file", "row_ord", "cells"])


RECORDS = "file string, row_ord long, cells array<string>"


def records(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Rows (file, row_ord, cells) of every record; ``row_ord`` rises through a file."""
    lines = _lines(spark, paths)
    # One row per block of 128 MB (or per file): small whatever the input.
    starts = block_starts(lines)
    body = lines.select("file", "block", F.col("value").cast("binary").alias("body"))
    whole = body.join(F.broadcast(starts.select("file", "block", "opened")), ["file", "block"]).select("file", "block", "opened", "body").mapInArrow(_whole_records, RECORDS)
    crossing = starts.where(F.col("opened") | F.col("open_end"))
    pieces = body.join(F.broadcast(crossing.select("file", "block", "opened")), ["file", "block"]).select("file", "block", "opened", "body").mapInArrow(
        _pieces, "file string, block long, kind long, row_ord long, text string"
    )
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = pieces.withColumn("record", F.sum(F.when(F.col("kind") == BEGUN, 1).otherwise(0)).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    put_together = numbered.groupBy("file", "record").agg(
        F.min(F.when(F.col("kind") == BEGUN, F.col("row_ord"))).alias("row_ord"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")
    )
    return whole.unionByName(put_together.select("file", "row_ord", "text").mapInArrow(_joined_records, RECORDS))


def read_text_tables(spark: SparkSession, paths: list[str] | str, *, part_ord: int = 0) -> DataFrame:
    """Every cell of every record, however wide; quote '"' doubled. Which
    members count is decided downstream by their names. Files are numbered in
    name order from the reader's own file index."""
    norm = lambda c: F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    order = [(p, i) for i, p in enumerate(sorted(spark.read.text(paths).inputFiles()))]
    ordered = spark.createDataFrame(order, "_listed string, file_ord int").select(norm(F.col("_listed")).alias("_key"), "file_ord")
    found = records(spark, paths).withColumn("_key", norm(F.col("file")))
    return found.join(ordered, "_key").select(
        F.lit(part_ord).alias("part_ord"), "file_ord", file_name(F.col("file")).alias("member"), F.lit(None).cast("string").alias("sheet"), "row_ord", "cells"
    )
