"""Operator 12: alignment of two tokenizers' tokens by interval coalescing.

Both tokenizers cut the same bytes (a space, then the text) into tokens, each
a byte interval. All A and B intervals of many texts are sorted by start
(texts lie one after another, so none touches the next), the running maximum
of their ends is taken, and a group breaks where a start reaches it: there A
and B tokens both end. Within the groups overlapping A and B tokens are
expanded to pairs, as many as the tokens of both at most; the pairs that end
together are the links.

``align`` returns the alignment itself: ids of both sides and the number of
tokens of each group. ``alignment_report`` makes the same alignments, keeps
their digests and links, counts linked id pairs over all texts and scores each
text's links by those counts. Of two tokens that end together one ends the
other, so the possible pairs are found in the two vocabularies beforehand, a
few hundred thousand whatever the data: a link is a number of that table, and
the counts are small enough for every worker.

A text that is null, empty, or does not come back byte for byte from either
side's tokens has none: empty lists, no groups. Repeated rows and null keys are
aligned like others. Only key and text are read, so other columns may have any
names. Empty tables give empty results. A long text is encoded in pieces; its
alignment is one row.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.llm import bpe, libraries
from regloom.llm.vocab import load
from regloom.session import written

LISTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]
LONGS = ["n_a", "n_b", "n_groups", "n_links"]


@functools.lru_cache(maxsize=4)
def a_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    vocab = load(path)
    out = [b""] * vocab.size
    for i, token in vocab.tokens.items():
        raw = vocab.word_bytes(token)
        out[i] = token.encode() if raw is None else raw
    return out


@functools.lru_cache(maxsize=4)
def b_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a piece vocabulary: U+2581 is a space, byte pieces are their byte."""
    sp = libraries.piece_tokenizer(path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(s[3:5], 16)]) if sp.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]


@functools.lru_cache(maxsize=4)
def possible_links(a_path: str, b_path: str) -> np.ndarray:
    """Sorted codes a << 32 | b of all id pairs of which one's bytes end the other's."""
    sides = a_bytes(a_path), b_bytes(b_path)
    of = [{}, {}]
    for names, ids in zip(sides, of, strict=True):
        for i, s in enumerate(names):
            ids.setdefault(s, []).append(i)
    found = set()
    for mine, names in enumerate(sides):
        for i, s in enumerate(names):
            for k in range(len(s)):
                for j in of[1 - mine].get(s[k:], ()):
                    found.add((j << 32 | i) if mine else (i << 32 | j))
    return np.array(sorted(found), np.int64)


@functools.lru_cache(maxsize=8)
def _sizes(path: str, side: str) -> np.ndarray:
    return np.array([len(s) for s in (a_bytes if side == "a" else b_bytes)(path)], np.int64)


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers (from 0) of A's and B's intervals."""
    start, end = np.concatenate((a_start, b_start)), np.concatenate((a_end, b_end))
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(np.concatenate(([False], start[order][1:] >= reach[:-1]))) if len(start) else 0
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping intervals; both sides sorted and without gaps between neighbours."""
    lo, hi = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left")
    many = np.maximum(hi - lo, 0)
    a = np.repeat(np.arange(len(a_start)), many)
    return a, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)


def links(a_ids: np.ndarray, b_ids: np.ndarray, a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of tokens that end together, for texts laid one after another."""
    a_end, b_end = np.cumsum(_sizes(a_path, "a")[a_ids]), np.cumsum(_sizes(b_path, "b")[b_ids])
    a, b = overlaps(np.concatenate(([0], a_end[:-1])) if len(a_end) else a_end, a_end, np.concatenate(([0], b_end[:-1])) if len(b_end) else b_end, b_end)
    both = a_end[a] == b_end[b]
    return a[both], b[both]


@dataclass
class Aligned:
    """Some texts' alignments one after another; ``a`` and ``b`` sides as pairs."""

    ids: tuple[np.ndarray, np.ndarray]
    counts: tuple[np.ndarray, np.ndarray]  # tokens of each text
    groups: tuple[np.ndarray, np.ndarray]  # group of each token, numbered through all texts
    per_text: np.ndarray  # groups of each text


def aligned(texts: list[str], a_path: str, b_path: str) -> Aligned:
    names = a_bytes(a_path), b_bytes(b_path)
    sides = [x.tolist() for x in libraries.encode_bytes(a_path, [" " + t for t in texts], True)], list(libraries.encode_pieces(b_path, texts))
    for k, t in enumerate(texts):
        want = b" " + t.encode("utf-8", "surrogatepass")
        if not t or any(b"".join(map(n.__getitem__, s[k])) != want for n, s in zip(names, sides, strict=True)):
            sides[0][k] = sides[1][k] = []
    counts = tuple(np.fromiter(map(len, s), np.int64, len(s)) for s in sides)
    ids = tuple(np.fromiter(itertools.chain.from_iterable(s), np.int64, int(n.sum())) for s, n in zip(sides, counts, strict=True))
    ends = [np.cumsum(_sizes(p, k)[x]) for p, k, x in zip((a_path, b_path), "ab", ids, strict=True)]
    groups = coalesce(*[x for e in ends for x in (np.concatenate(([0], e[:-1])) if len(e) else e, e)])
    owner = np.zeros(int(groups[0][-1]) + 1 if len(groups[0]) else 0, np.int64)
    owner[groups[0]] = np.repeat(np.arange(len(texts)), counts[0])
    return Aligned(ids, counts, groups, np.bincount(owner, minlength=len(texts)))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, a_ids, b_ids, a_sizes, b_sizes): both sides' ids, and how many of each the groups take in turn."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            done = 0
            for block in libraries.blocks(bpe.texts_of(b, text)):
                x = aligned(block, a_path, b_path)
                many = int(x.per_text.sum())
                lists = [*[_lists(i, n) for i, n in zip(x.ids, x.counts, strict=True)], *[_lists(np.bincount(g, minlength=many), x.per_text) for g in x.groups]]
                yield pa.RecordBatch.from_arrays([b.column(key).slice(done, len(block)), *lists], names=[key, *LISTS])
                done += len(block)

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{c} array<int>" for c in LISTS))


@functools.lru_cache(maxsize=2)
def _written_ids(size: int) -> tuple[np.ndarray, ...]:
    """Decimal ids followed by each separator."""
    return tuple(np.array([b"%d%s" % (i, sep) for i in range(size)], object) for sep in (b",", b"|", b";"))


def group_digests(x: Aligned, size: int) -> list[str]:
    """SHA-256 of each text's groups written as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    comma, bar, semicolon = _written_ids(size)
    written_ids = []
    for ids, groups, last in zip(x.ids, x.groups, (bar, semicolon), strict=True):
        some = comma[ids]
        end = np.append(groups[1:] != groups[:-1], [True])[: len(ids)]
        some[end] = last[ids[end]]
        written_ids.append(some)
    place = np.argsort(np.concatenate((2 * x.groups[0], 2 * x.groups[1] + 1)), kind="stable")
    parts = np.concatenate(written_ids)[place].tolist()
    cut = np.concatenate(([0], np.cumsum(x.counts[0] + x.counts[1]))).tolist()
    return [hashlib.sha256(b"".join(parts[i:j])[:-1]).hexdigest() if j > i else "" for i, j in itertools.pairwise(cut)]


def summaries(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, groups_sha256, links): each text's links as numbers of ``possible_links``."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(possible_links(a_path, b_path))

    def run(batches):
        codes, size = shared.value, max(len(a_bytes(a_path)), len(b_bytes(b_path)))
        for batch in batches:
            done = 0
            for block in libraries.blocks(bpe.texts_of(batch, text)):
                x = aligned(block, a_path, b_path)
                a, b = links(*x.ids, a_path, b_path)
                found = np.searchsorted(codes, x.ids[0][a] << 32 | x.ids[1][b])
                n_links = np.bincount(np.repeat(np.arange(len(block)), x.counts[0])[a], minlength=len(block))
                numbers = [pa.array(c.astype(np.int64)) for c in (*x.counts, x.per_text, n_links)]
                cols = [*numbers, pa.array(group_digests(x, size), pa.string()), _lists(found, n_links)]
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(done, len(block)), *cols], names=[key, *LONGS, "groups_sha256", "links"])
                done += len(block)

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{c} long" for c in LONGS) + ", groups_sha256 string, links array<int>")


def link_counts(summary: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows (link, b, n, best): how many links of the whole corpus are this one, its B id, and whether no other link of that id has more."""
    spark = summary.sparkSession
    counts = summary.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    ids = spark.createDataFrame(pa.table({"link": pa.array(np.arange(len(possible_links(a_path, b_path)), dtype=np.int32)), "b": pa.array((possible_links(a_path, b_path) & 0xFFFFFFFF).astype(np.int32))}))
    return counts.join(ids, "link").withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def scores(summary: DataFrame, counts: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    n_best: links whose count is the highest of their B id; count_sum: the sum
    of the links' counts. The counts (at most ``possible_links`` rows) go to
    every worker.
    """
    table = counts.select("link", "n", "best").toPandas()
    number, best = (np.zeros(int(table["link"].max()) + 1 if len(table) else 0, t) for t in (np.int64, bool))
    number[table["link"]], best[table["link"]] = table["n"], table["best"]
    shared = summary.sparkSession.sparkContext.broadcast((number, best))
    kind = summary.schema[key].dataType.simpleString()
    kept = [key, *LONGS, "groups_sha256"]

    def run(batches):
        number, best = shared.value
        for batch in batches:
            lists = batch.column("links")
            ends = lists.offsets.to_numpy()
            link, rows = lists.values.to_numpy()[ends[0] : ends[-1]], np.repeat(np.arange(batch.num_rows), np.diff(ends))
            count_sum = np.zeros(batch.num_rows, np.int64)
            np.add.at(count_sum, rows, number[link])
            n_best = np.bincount(rows[best[link]], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n_best.astype(np.int64)), pa.array(count_sum)], names=[*kept, "n_best", "count_sum"])

    scored = summary.select(*kept, "links").mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{c} long" for c in LONGS) + ", groups_sha256 string, n_best long, count_sum long")
    return scored.select(key, *LONGS, "n_best", "count_sum", "groups_sha256")


def alignment_report(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of every document's alignment; digests and links are written once and read for the counts and for the scores."""
    summary = written(summaries(docs, a_path, b_path, text=text, key=key), "links")
    return scores(summary, link_counts(summary, a_path, b_path), key=key)
