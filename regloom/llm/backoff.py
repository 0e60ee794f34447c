"""Operator 3: stupid-backoff language model scores.

A word is scored by the longest n-gram ending in it that other documents
contain: count(n-gram) / count(its context), times ``ALPHA`` for every word by
which the context had to be shortened; a word that no other document has
counts as one occurrence more. A document's own n-grams are taken off all
counts, otherwise every n-gram of its own would be known. Scores are natural
logarithms, summed per document.

The corpus counts are relations partitioned by the n-grams' 64-bit hashes. So
that a frequent n-gram isn't shuffled once per occurrence, documents are dealt
to blocks of a few megabytes by hash. Texts are cut into words once: a block is
stored as its different words' hashes and one short number per word, in a table
bucketed by block, and all later steps roll their n-grams from there. A block's
n-grams are counted inside it, and one row per (block, hash range) carries its
distinct hashes and counts. Rows of one hash range meet in one group (its size
is fixed: the number of ranges follows the corpus), the totals are summed there
and joined back to each block's n-grams, and the blocks add up the logarithms
per document. Everything counted covers the whole corpus.

Hashes take far more room than totals, most of which are small numbers. So the
hash ranges are counted in ``PASSES`` jobs, one after the other; each writes its
ranges' totals, and only one job's hashes are on disk at a time.

Words are runs of anything but ASCII white space. A null or empty text has no
words: n_words 0 and a null mean. Repeated rows are documents of their own, so
they know each other's n-grams. Only the key and text columns are read. An
empty table gives no rows.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm.repetition import mixed, rolling
from regloom.session import written, written_by

ORDER, ALPHA = 3, 0.4
#: Text bytes of a block, and n-grams of a hash range (both on average).
BLOCK_BYTES, RANGE_NGRAMS = 4 << 20, 4 << 20
#: Jobs that the hash ranges are counted in.
PASSES = 3


def planes(x: np.ndarray, width: int = 8) -> bytes:
    """Numbers of ``width`` bytes, byte by byte: the high bytes, mostly zeros, lie together and compress away."""
    return np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(raw: bytes, width: int = 8) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


def words_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, each word's number, hash of each number)."""
    whole = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks] or [pa.array([], pa.large_string())]).fill_null("")
    split = pc.ascii_split_whitespace(whole)
    found = split.values.dictionary_encode()
    filled = pc.binary_length(split.values).to_numpy() > 0  # white space at an end of a text gives an empty word
    text = np.repeat(np.arange(len(whole)), np.diff(split.offsets.to_numpy()))
    ends, data = np.frombuffer(found.dictionary.buffers()[1], np.int64)[: len(found.dictionary) + 1].tolist(), memoryview(found.dictionary.buffers()[2] or b"")
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(data[lo:hi]) for lo, hi in zip(ends, ends[1:], strict=False)), np.uint64, len(found.dictionary))
    return np.bincount(text[filled], minlength=len(whole)), found.indices.to_numpy()[filled], hashes


def ngrams(words: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(text of each word, hashes by n, index of the last word of each hash by n) of texts of ``sizes`` words, given by the words' hashes."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    hashes, ends = [], []
    for n in range(1, order + 1):
        keys = rolling(words, n)
        at = np.nonzero(doc[: len(keys)] == doc[n - 1 :])[0] if len(keys) else np.empty(0, np.int64)
        hashes.append(mixed(keys[at] + np.uint64(n)))
        ends.append(at + n - 1)
    return doc, hashes, ends


def in_order(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the hashes and leaves equal ones in their order, whether a new hash begins at each place there).

    High bits and place are sorted as one number, which is several times faster
    than sorting places; the few different hashes that agree in the high bits
    are put right afterwards.
    """
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, bool)
    low, bits = hashes.min(), np.uint64(len(hashes).bit_length())
    packed = (hashes - low) << np.uint64(64 - max(1, int(hashes.max() - low).bit_length()))
    packed = (packed >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    packed >>= bits
    ranked = hashes[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    mixed_up = np.unique(packed[1:][new[1:] & (packed[1:] == packed[:-1])])
    for lo, hi in zip(np.searchsorted(packed, mixed_up), np.searchsorted(packed, mixed_up, "right"), strict=True):
        order[lo:hi] = order[lo:hi][np.argsort(ranked[lo:hi], kind="stable")]
    if len(mixed_up):
        ranked = hashes[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
    return order, new


def run_lengths(new: np.ndarray) -> np.ndarray:
    """Length of each run, by the places where runs begin."""
    return np.diff(np.append(np.nonzero(new)[0], len(new)))


def _edges(ranges: int) -> np.ndarray:
    """Lower bounds of equal parts of the hash space."""
    return np.array([-(-(i << 64) // ranges) for i in range(ranges)], dtype=np.uint64)


def block_scores(words: np.ndarray, sizes: np.ndarray, totals: np.ndarray, corpus_words: int, order: int, alpha: float) -> np.ndarray:
    """Summed log score of each text; totals: corpus counts of the block's distinct hashes in ascending order."""
    doc, hashes, ends = ngrams(words, sizes, order)
    by_hash, new = in_order(np.concatenate(hashes))
    text = doc[np.concatenate(ends)][by_hash]  # ascending inside a hash, so an n-gram's places in one text are a run
    own = run_lengths(new | np.append(True, text[1:] != text[:-1])[: len(new)])
    counts = np.empty(len(by_hash), np.int64)  # in other documents
    counts[by_hash] = np.repeat(totals.astype(np.int64), run_lengths(new)) - np.repeat(own, own)
    at = 0
    others: list[np.ndarray] = []  # by n, for the word each n-gram ends in: its count in other documents (0 where there is none)
    for end in ends:
        k = np.zeros(len(doc), np.int64)
        k[end] = counts[at : at + len(end)]
        others.append(k)
        at += len(end)
    rest = corpus_words - sizes[doc]
    score = np.where(others[0] > 0, np.log(np.maximum(others[0], 1) / np.maximum(rest, 1)), -np.log(rest + 1.0))
    for n in range(1, order):
        context = np.concatenate(([0], others[n - 1][:-1]))
        longer = np.log(np.maximum(others[n], 1) / np.maximum(context, 1))
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        score = np.where(others[n] > 0, longer, score + np.where(place >= n, math.log(alpha), 0.0))
    return np.bincount(doc, weights=score, minlength=len(sizes))


def scores(docs: DataFrame, *, text: str = "text", key: str = "doc_id", order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """One row per document: (key, n_words, log_score, mean_log_score)."""
    total_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-total_bytes // BLOCK_BYTES))
    kind = docs.schema[key].dataType.simpleString()
    dealt = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.pmod(F.xxhash64(key, text), F.lit(blocks)).alias("block"))

    def cut(name: tuple, table: pa.Table) -> pa.Table:
        sizes, numbers, hashes = words_of(table["text"])
        ids = pa.concat_arrays(table["id"].chunks)
        columns = [[name[0].as_py()], [len(numbers)], pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), [planes(sizes)], [planes(numbers, 4)], [planes(hashes)]]
        return pa.Table.from_arrays([pa.array(c, t) if isinstance(c, list) else c for c, t in zip(columns, (pa.int64(), pa.int64(), None, *[pa.binary()] * 3), strict=True)], names=["block", "words", "ids", "sizes", "numbers", "hashes"])

    def words(table: pa.Table | pa.RecordBatch, row: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, words per text) of a stored block."""
        sizes, numbers, hashes = (from_planes(table[c][row].as_py(), w) for c, w in (("sizes", 8), ("numbers", 4), ("hashes", 8)))
        return hashes[numbers], sizes.astype(np.int64)

    stored = written_by(dealt.groupBy("block").applyInArrow(cut, f"block long, words long, ids array<{kind}>, sizes binary, numbers binary, hashes binary"), "blocks", "block")
    total_words = stored.agg(F.sum("words")).first()[0] or 0
    ranges = max(1, -(-total_words * order // RANGE_NGRAMS))

    def counter(first: int, end: int):
        """Counts of the ranges from ``first`` to below ``end``."""
        edges = _edges(ranges)

        def count(batches):
            for b in batches:
                for at, block in enumerate(b["block"].to_pylist()):
                    found = np.concatenate(ngrams(*words(b, at), order)[1])
                    found = found[found >= edges[first]]
                    keys, n = np.unique(found[found < edges[end]] if end < ranges else found, return_counts=True)
                    cuts = np.append(np.searchsorted(keys, edges[first:end]), len(keys)).tolist()
                    rows = [(r, block, planes(np.diff(keys[lo:hi], prepend=np.uint64(0))), planes(n[lo:hi])) for r, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False), first) if lo < hi]
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["range", "block", "keys", "n"])

        return count

    def total(name: tuple, table: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(x), dtype=np.uint64) for x in table["keys"].to_pylist()]
        n = np.concatenate([from_planes(x) for x in table["n"].to_pylist()])
        by_key, new = in_order(np.concatenate(keys))
        summed = np.empty(len(n), np.uint64)
        summed[by_key] = np.repeat(np.add.reduceat(n[by_key], np.nonzero(new)[0]), run_lengths(new))
        answer = np.split(summed, np.cumsum([len(k) for k in keys])[:-1])
        return pa.Table.from_arrays([table["block"], table["range"], pa.array([planes(a) for a in answer], pa.binary())], names=["block", "range", "totals"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = sorted(zip(right["range"].to_pylist(), right["totals"].to_pylist(), strict=True))
        totals = np.concatenate([np.empty(0, np.uint64), *[from_planes(x) for _, x in parts]])
        hashes, sizes = words(left)
        summed = block_scores(hashes, sizes, totals, total_words, order, alpha)
        mean = [s / n if n else None for s, n in zip(summed.tolist(), sizes.tolist(), strict=True)]
        return pa.Table.from_arrays([left["ids"].chunk(0).flatten(), pa.array(sizes, pa.int64()), pa.array(summed, pa.float64()), pa.array(mean, pa.float64())], names=[key, "n_words", "log_score", "mean_log_score"])

    def totals_of(first: int, end: int) -> DataFrame:
        counted = stored.mapInArrow(counter(first, end), "range long, block long, keys binary, n binary")
        return written(counted.groupBy("range").applyInArrow(total, "block long, range long, totals binary"), "totals")

    passes = min(PASSES, ranges)
    cuts = [ranges * i // passes for i in range(passes + 1)]
    totals = reduce(DataFrame.unionByName, [totals_of(*cut) for cut in zip(cuts, cuts[1:], strict=False)])
    return stored.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, f"{key} {kind}, n_words long, log_score double, mean_log_score double")


def oracle(table: str = "documents", order: int = ORDER, alpha: float = ALPHA) -> str:
    """The same scores in DuckDB SQL, by window counts over the words themselves."""
    before = [f"lag(w, {n}) OVER (PARTITION BY doc_id ORDER BY i) AS p{n}" for n in range(1, order)]
    grams = [[f"p{k}" for k in range(n - 1, 0, -1)] + ["w"] for n in range(1, order + 1)]
    others = [f"count(*) OVER (PARTITION BY {', '.join(g)}) - count(*) OVER (PARTITION BY doc_id, {', '.join(g)}) AS k{n}" for n, g in enumerate(grams, 1)]
    contexts = [f"lag(k{n}) OVER (PARTITION BY doc_id ORDER BY i) AS c{n}" for n in range(1, order)]
    score = "CASE WHEN k1 > 0 THEN ln(k1 / (total - own)) ELSE -ln(total - own + 1.0) END"
    for n in range(2, order + 1):
        score = f"CASE WHEN i < {n} THEN {score} WHEN k{n} > 0 THEN ln(k{n} / c{n - 1}) ELSE ln({alpha}) + {score} END"
    return f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM {table}),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
placed AS (SELECT doc_id, i, w, {', '.join(before)} FROM words),
counted AS (SELECT doc_id, i, {', '.join(others)}, count(*) OVER (PARTITION BY doc_id) AS own, (SELECT count(*) FROM words) AS total FROM placed),
known AS (SELECT *, {', '.join(contexts)} FROM counted),
scored AS (SELECT doc_id, {score} AS s FROM known),
summed AS (SELECT doc_id, sum(s) AS s, count(*) AS n FROM scored GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, round(s / n, 6) AS mean_log_score
FROM split LEFT JOIN summed USING (doc_id)
"""
