"""Operator 6: hierarchical multi-length packing.

Each document's token stream (its ids, then an end id) is cut into full
windows of the longest context and one remainder, which is routed to the
smallest context tier that holds it. Only the number of remainders of each
length decides how tiers are packed, so the plan is made from a histogram of
at most ``context`` numbers, whatever the size of the data: tiers from long to
short open windows with their longest pieces and fill the gap with the longest
shorter pieces that fit, down to the shortest tier; windows of a shorter tier
are used only where they come out exactly full (a power of two needs no
padding), the rest share windows of the full context. Pieces whose window
would keep more than a ``MAX_PADDING`` share of padding (no shorter ones are
left to fill it) are chained instead: laid end to end through windows of the
full context and cut where a window ends, so whatever lengths the documents
have, only the chain's last window is padded. A plan line says which ranks of
a length go to which sequences at which offset, or where in the chain they
begin; pieces find their line by their rank within their length. Sequences of
a tier are dealt in turn to step groups of equal token counts.

Ranks are counted without gathering a length in one place: each task numbers
its own pieces of each length while it writes them, and per-task counts are
summed to offsets.

A null text is the empty text (one piece: the end id). Repeated rows are
packed as often as they occur. Only the key and text columns are read, so
others may have any names. An empty table gives no rows.
"""
from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.llm import bpe, libraries
from regloom.session import written

#: Context sizes (powers of two), and the tokens of a step group in production.
TIERS, STEP_TOKENS = (1024, 512, 256, 128), 64 * 1024
END_ID = 0
#: Largest share of a window that may stay empty before its pieces are chained.
MAX_PADDING = 1 / 128


@dataclass(frozen=True)
class Line:
    """Ranks [lo, lo + count) of pieces of ``length`` go to sequences first.. at ``offset``;
    chained ones lie one after another from place ``offset`` of the chain, which begins with sequence ``first``."""

    length: int
    lo: int
    count: int
    first: int
    offset: int
    tier: int
    chained: bool = False


def plan(histogram: dict[int, int], tiers: Sequence[int] = TIERS) -> tuple[list[Line], dict[int, tuple[int, int]]]:
    """Plan lines, and for each tier its first sequence and number of sequences.

    Every step of the loops uses up a length or fixes the number of one
    pattern, so the plan's size depends on the context size alone.
    """
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    top = max(tiers)
    patterns: list[tuple[int, list[int], int]] = []

    def fill(room: int, used: Counter) -> list[int]:
        out = []
        while room > 0:
            n = next((n for n in range(room, 0, -1) if left[n] > used[n]), None)
            if n is None:
                break
            out.append(n)
            used[n] += 1
            room -= n
        return out

    held, chain = Counter(), Counter()

    def close(tier: int, pieces: list[int], used: Counter) -> None:
        times = min(left[x] // k for x, k in used.items())
        if top - sum(pieces) > MAX_PADDING * top and tier == top:
            chain.update({x: k * times for x, k in used.items()})
        else:
            patterns.append((tier, pieces, times))
        for x, k in used.items():
            left[x] -= k * times

    for i, tier in enumerate(tiers):
        floor = tiers[i + 1] if i + 1 < len(tiers) else 0
        for n in range(tier, floor, -1):
            while left[n] > 0:
                used = Counter({n: 1})
                pieces = [n, *fill(tier - n, used)]
                if tier < top and sum(pieces) < tier:  # would be padded: share a full-context window instead
                    held[n] += left[n]
                    left[n] = 0
                    break
                close(tier, pieces, used)
    left = held
    for n in range(top, 0, -1):
        while left[n] > 0:
            used = Counter({n: 1})
            close(top, [n, *fill(top - n, used)], used)
    lines, spans, taken, first = [], {}, Counter(), 0
    for tier in tiers:
        begin = first
        for _, pieces, times in (p for p in patterns if p[0] == tier):
            offset = 0
            for n in pieces:
                lines.append(Line(n, taken[n], times, first, offset, tier))
                taken[n] += times
                offset += n
            first += times
        if tier == top:
            place = 0
            for n in sorted(chain, reverse=True):
                lines.append(Line(n, taken[n], chain[n], first, place, tier, True))
                taken[n] += chain[n]
                place += n * chain[n]
            first += -(-place // top)
        spans[tier] = (begin, first - begin)
    return lines, spans


NAMES = ["start", "length", "ids_crc32", "doc_tokens", "part", "place"]


def pieces(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", context: int = TIERS[0]) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens, part, place, ids): the cut documents, numbered by task and
    length; ``ids`` of pieces shorter than the context, which may be cut again."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, part int, place long, ids array<int>"
    end = np.array([END_ID], np.uint32)

    def run(batches):
        part, numbered = TaskContext.get().partitionId(), defaultdict(int)
        for b in batches:
            done = 0
            for block in bpe.blocks(bpe.texts_of(b, text)):
                at, rows, short = [], [], []
                for k, found in enumerate(libraries.encode_bytes(path, block), done):
                    ids = np.append(found, end)
                    for start in range(0, len(ids), context):
                        some = ids[start : start + context]
                        n = len(some)
                        rows.append((start, n, zlib.crc32(some), len(ids), part, numbered[n]))
                        short.append(some if n < context else end[:0])
                        at.append(k)
                        numbered[n] += 1
                done += len(block)
                cols = [pa.array(c, pa.int32() if name == "part" else pa.int64()) for name, c in zip(NAMES, zip(*rows, strict=True), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, short)]), pa.int32()), pa.array(np.concatenate(short).view(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at)), *cols, lists], names=[key, *NAMES, "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group).

    Sequence ids are gapless from 0, offsets inside a sequence gapless from 0;
    ``tier`` is the context size the sequence is meant for.
    """
    top = max(tiers)
    cut = written(pieces(docs, path, text=text, key=key, context=top), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `context` rows
    lines, spans = plan(histogram, tiers)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = cut.join(offsets, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).select(
        key, "start", "length", "ids_crc32", "doc_tokens", (F.col("_before") + F.col("place")).alias("rank"), "ids"
    )
    of_length: dict[int, list[Line]] = defaultdict(list)
    for x in lines:
        of_length[x.length].append(x)
    tables = docs.sparkSession.sparkContext.broadcast(
        {n: tuple(np.array([getattr(x, c) for x in xs], np.int64) for c in ("lo", "first", "offset", "tier", "chained")) for n, xs in of_length.items()}
    )
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    schema = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

    def place(batches):
        for b in batches:
            start, n, crc, total, rank = (b.column(c).to_numpy(zero_copy_only=False).copy() for c in ("start", "length", "ids_crc32", "doc_tokens", "rank"))
            sequence, offset, tier = (np.zeros(len(n), np.int64) for _ in range(3))
            for length in np.unique(n):
                lo, first, off, t, chained = tables.value[int(length)]
                at = np.nonzero(n == length)[0]
                k = np.searchsorted(lo, rank[at], side="right") - 1
                nth = rank[at] - lo[k]
                through = off[k] + nth * length  # places in the chain
                sequence[at] = first[k] + np.where(chained[k] == 1, through // top, nth)
                offset[at] = np.where(chained[k] == 1, through % top, off[k])
                tier[at] = t[k]
            over = np.nonzero(offset + n > top)[0]  # cut where a window of the chain ends
            row = np.concatenate((np.arange(len(n)), over))
            if len(over):
                lists = b.column("ids")
                ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
                head = top - offset[over]
                parts = [(ids[ends[i] : ends[i] + h], ids[ends[i] + h : ends[i + 1]]) for i, h in zip(over.tolist(), head.tolist(), strict=True)]
                start, total, tier = start[row], total[row], tier[row]
                start[-len(over) :] += head
                n, tail = n[row], n[over] - head
                n[over], n[-len(over) :] = head, tail
                crc = crc[row]
                crc[over], crc[-len(over) :] = [zlib.crc32(x) for x, _ in parts], [zlib.crc32(y) for _, y in parts]
                sequence, offset = sequence[row], offset[row]
                sequence[-len(over) :] += 1
                offset[-len(over) :] = 0
            begin, many = (np.vectorize(lambda t, i=i: spans[t][i], otypes=[np.int64])(tier) if len(tier) else tier for i in (0, 1))
            groups = np.maximum(1, -(-many * tier // step_tokens))
            cols = [start, n, crc, total, sequence, offset, tier.astype(np.int32), (sequence - begin) % groups]
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(row)), *map(pa.array, cols)], names=names)

    return ranked.mapInArrow(place, schema)
