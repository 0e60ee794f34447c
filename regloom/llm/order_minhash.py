"""Operator 2: document fingerprints by Order MinHash.

Every k-mer of a text's code points is numbered by its occurrence, so that
repeated k-mers are different elements, and hashed once. The top bits of the
hash deal the elements into lanes (one permutation serves all lanes); of each
lane the ``TUPLE`` smallest are selected, put back into the order in which
they stand in the text, and the hash of that tuple is the lane's entry. Equal
texts have equal fingerprints; an edit that moves or replaces text changes
selected k-mers or their order, so the share of equal lanes falls with the edit
distance.

Texts are padded at the end, so a text shorter than k has k-mers too. Lanes
without an element are empty and don't count; two texts without any code point
are alike (1.0). A null text is the empty text.

``neighbours`` fingerprints each text, its edited form (the last third
replaced by the beginning of the next document in descending key order, the
first document's after the last) and compares them. Documents are dealt to
ranges of the key; the document at each range's lower bound goes to the range
above as well, so every row meets its successor in its own task. Rows with
equal keys follow each other in the order of their texts; rows without a key
come last. Other columns are left aside. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm.repetition import mixed, rolling

#: Code points of a k-mer, lanes (a power of two), and k-mers selected for a lane.
K, LANES, TUPLE = 8, 64, 2
_LANE_SHIFT = np.uint64(64 - LANES.bit_length() + 1)
_PAD = "\x00"
#: Elements of a lane that are looked at first; a lane with fewer than TUPLE of them is looked at whole.
_EXPECTED = 16
#: A task works on at most so many texts and about so many code points at once.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 2048, 1 << 19


def _numbered(kmers: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of each (k-mer, number of its earlier occurrences in the text)."""
    keys = mixed(kmers + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = kmers.copy()
    if same.any():
        run = np.concatenate(([0], np.cumsum(~same)))
        twin = np.zeros(len(keys), bool)
        twin[1:] |= same
        twin[:-1] |= same
        place = np.sort(run[twin] * len(keys) + order[twin])  # by run, then by place in the text
        run, at = place // len(keys), place % len(keys)
        first = np.concatenate(([True], run[1:] != run[:-1]))
        begin = np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
        out[at] += mixed((np.arange(len(run)) - begin).astype(np.uint64)) * (~first).astype(np.uint64)
    return mixed(out)


def _lanes(hashes: np.ndarray, at: np.ndarray, doc: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries, number of selected elements) as count x LANES arrays, from the elements ``at`` (ascending)."""
    order = at[np.argsort((doc[at].astype(np.uint64) << np.uint64(52)) | (hashes[at] >> np.uint64(12)))]
    h = hashes[order]
    cell = doc[order] * LANES + (h >> _LANE_SHIFT).astype(np.int64)
    begin = np.nonzero(np.concatenate(([True], cell[1:] != cell[:-1])))[0] if len(cell) else np.empty(0, np.int64)
    size = np.diff(np.concatenate((begin, [len(cell)])))
    entry = np.zeros(count * LANES, np.uint64)
    found = np.zeros(count * LANES, np.int64)
    found[cell[begin]] = size
    for n in range(1, TUPLE + 1):
        these = begin[size >= n] if n == TUPLE else begin[size == n]
        if not len(these):
            continue
        picked = these[:, None] + np.arange(n)
        place = np.argsort(order[picked], axis=1)
        value = np.zeros(len(these), np.uint64)
        for j in range(n):
            value = mixed(value * np.uint64(3) + np.take_along_axis(h[picked], place[:, j : j + 1], axis=1)[:, 0] + np.uint64(1))
        entry[cell[these]] = value % np.uint64(65_535) + np.uint64(1)
    return entry.reshape(count, LANES).astype(np.uint16), found.reshape(count, LANES)


def fingerprints(texts: list[str]) -> np.ndarray:
    """Fingerprint of each text: LANES numbers of 16 bits, 0 for an empty lane."""
    count = len(texts)
    n = np.fromiter(map(len, texts), np.int64, count)
    pad = _PAD * (K - 1)
    points = np.frombuffer("".join([t + pad for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    kmers = np.concatenate((rolling(points + np.uint64(1), K), np.zeros(K - 1 if len(points) else 0, np.uint64)))
    begin = np.cumsum(n + K - 1) - (n + K - 1)
    doc = np.repeat(np.arange(count), n)
    at = np.arange(len(doc)) + np.repeat(begin - (np.cumsum(n) - n), n)
    hashes = _numbered(kmers[at], doc) if len(doc) else np.empty(0, np.uint64)
    rest = hashes << np.uint64(64 - int(_LANE_SHIFT))
    share = np.minimum(1.0, LANES * _EXPECTED / np.maximum(n, 1))
    limit = np.where(share < 1, share * 2.0**64, 0).astype(np.uint64)
    near = (rest < limit[doc]) | (limit[doc] == 0)
    entry, found = _lanes(hashes, np.nonzero(near)[0], doc, count)
    short = np.nonzero((found < TUPLE).any(axis=1) & (share < 1))[0]
    if len(short):
        again = np.zeros(count, bool)
        again[short] = True
        entry[short] = _lanes(hashes, np.nonzero(again[doc])[0], doc, count)[0][short]
    return entry


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal lanes among those that either side has (1 where neither has any), row by row."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    return np.where(used > 0, ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1), 1.0)


def _hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints.astype(">u2")]


def edited(text: str, following: str) -> str:
    """The last floor(n/3) code points replaced by the first as many (or all) of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_column(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, fingerprint): one narrow pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [t if t is not None else "" for t in b.column(text).to_pylist()]
            prints = [x for lo, hi in _cuts(texts) for x in _hex(fingerprints(texts[lo:hi]))]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(prints, pa.string())], names=[key, "fingerprint"])

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, fingerprint string")


def _cuts(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= CHARS_AT_ONCE or i + 1 - lo >= TEXTS_AT_ONCE:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _with_successors(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows (range, halo, id, text), each range sorted: documents by descending key, then the first of the next range."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    shares = [i / parts for i in range(1, parts + 1)]
    # One number per range reaches the driver; every bound is the key of a document.
    found = docs.select(place.alias("k")).agg(F.percentile_approx("k", shares, 100 * parts).alias("b"), F.max("k").alias("top")).first()
    bounds = np.array(sorted({*(found["b"] or []), *([] if found["top"] is None else [found["top"]])}), np.int64)
    last = max(len(bounds), 1)

    @F.pandas_udf("range int, bound boolean")
    def dealt(k: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, k.to_numpy())
        return pd.DataFrame({"range": at.astype(np.int32), "bound": bounds[np.minimum(at, last - 1)] == k.to_numpy()})

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), place.alias("k")).withColumn("to", dealt("k"))
    here = F.struct(F.col("to.range").alias("range"), F.lit(False).alias("halo"))
    above = F.struct(F.pmod(F.col("to.range") + 1, F.lit(last)).alias("range"), F.lit(True).alias("halo"))
    sent = rows.select("id", "text", "k", F.explode(F.when(F.col("to.bound"), F.array(here, above)).otherwise(F.array(here))).alias("at"))
    return (
        sent.select(F.col("at.range").alias("range"), F.col("at.halo").alias("halo"), "id", "text", "k")
        .repartitionById(last, F.col("range")).sortWithinPartitions("range", "halo", F.desc("k"), "text").select("range", "halo", "id", "text")
    )


def neighbours(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def table(ids: list, texts: list[str], prints: np.ndarray, following: np.ndarray, changed: list[str]) -> pa.RecordBatch:
        other = fingerprints(changed)
        cols = [
            pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
            pa.array(_hex(prints)), pa.array(_hex(other)), pa.array(likeness(prints, other)), pa.array(likeness(prints, following)),
        ]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *cols], names=names)

    def run(batches):
        waiting = None  # (id, text, fingerprint) whose successor is the next row
        closed = False  # the range's first halo row has been met
        at = None
        for b in batches:
            ranges, halos, ids, texts = (b.column(i).to_pylist() for i in range(4))
            texts = [t if t is not None else "" for t in texts]
            for lo, hi in _cuts(texts):
                prints = fingerprints(texts[lo:hi])
                own, own_texts, mine, theirs, changed = [], [], [], [], []
                for i in range(lo, hi):
                    if ranges[i] != at:
                        at, waiting, closed = ranges[i], None, False
                    if waiting is not None and not closed:
                        own.append(waiting[0]), own_texts.append(waiting[1]), mine.append(waiting[2]), theirs.append(prints[i - lo]), changed.append(edited(waiting[1], texts[i]))
                    if halos[i]:
                        closed, waiting = True, None
                    else:
                        waiting = (ids[i], texts[i], prints[i - lo])
                if own:
                    yield table(own, own_texts, np.array(mine), np.array(theirs), changed)

    schema = f"{key} {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_successors(docs, text, key).mapInArrow(run, schema)
