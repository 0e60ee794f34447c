"""Operator 8: quality rules by repetition coverage.

Words (maximal runs of anything but ASCII white space) become 64-bit numbers;
rolling hashes over them, for several n-gram lengths, are computed in numpy for
about a megabyte of texts at once, and a sort by (document, hash) finds the
windows that equal an earlier window of the same document. The characters of
the words that such windows cover, and of lines equal to an earlier line, are
measured against the document's characters in words.

A document is kept if no base rule fails (at least ``MIN_WORDS`` words, at most
half of them in three-word windows that occur twice or more) and none of the
coverage shares is above its limit.

A null text is the empty text: no words, so the base rules fail. Measures are
of one document alone: repeated rows give equal results. Reports carry the key
column only; ``keep_clean`` returns the input's own columns, whatever their
names. An empty table gives no rows.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regloom.llm.bpe import blocks, texts_of

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
#: Largest share of characters inside n-grams that repeat an earlier one, by n-gram length.
NGRAM_LIMITS: Mapping[int, float] = {5: 0.15, 7: 0.13, 10: 0.10}
#: Largest share of the characters in lines that lines equal to an earlier one may hold.
LINE_CHAR_LIMIT = 0.20
SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\x0b\x0c\r"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range (multiply, fold, multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every window of ``n`` numbers (modulo 2**64)."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out = out * _STEP + words[j : j + size]
    return mixed(out)


def repeated(words: np.ndarray, doc: np.ndarray, n: int, *, first: bool) -> np.ndarray:
    """Flags of the words inside windows of ``n`` that occur again in their document; ``first``: count the first occurrence too."""
    covered = np.zeros(len(words), bool)
    keys = rolling(words, n)
    if not len(keys):
        return covered
    inside = doc[: len(keys)] == doc[n - 1 :]
    keys = mixed(keys + doc[: len(keys)].astype(np.uint64) * _STEP)
    at = np.nonzero(inside)[0]
    order = np.argsort(keys[at])
    ranked = keys[at][order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return covered
    twin = np.zeros(len(ranked), bool)
    twin[1:] |= same
    twin[:-1] |= same
    if not first:
        begins = np.concatenate(([0], np.nonzero(~same)[0] + 1))
        leader = np.minimum.reduceat(at[order], begins)
        starts = np.setdiff1d(at[order][twin], leader, assume_unique=True)
    else:
        starts = at[order][twin]
    edge = np.zeros(len(words) + 1, np.int32)
    edge[starts] += 1
    np.subtract.at(edge, starts + n, 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str], limits: Mapping[int, float] = NGRAM_LIMITS) -> dict[str, np.ndarray]:
    """Counts, shares and the verdict for each text, as arrays."""
    count = len(texts)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]
    sizes = np.fromiter(map(len, split), np.int64, count)
    flat = [w for ws in split for w in ws]
    words = mixed(np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64))
    doc = np.repeat(np.arange(count), sizes)
    out = {
        "n_words": sizes,
        "word_chars": np.array([len(t) - sum(map(r.count, _EACH_WHITE)) for t, r in zip(texts, raw, strict=True)], np.int64).reshape(count),
        "n_symbols": np.array([sum(map(r.count, _EACH_SYMBOL)) for r in raw], np.int64).reshape(count),
    }
    line_stats = np.array([_lines(r) for r in raw], np.int64).reshape(count, 3)
    out["n_dup_lines"] = line_stats[:, 1]
    again = repeated(words, doc, REPEAT_WINDOW, first=True)
    out["n_repeat_words"] = np.bincount(doc[again], minlength=count).astype(np.int64)
    out["base_failed"] = (sizes < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * sizes)
    whole = np.maximum(out["word_chars"], 1)
    out["dup_line_share"] = line_stats[:, 1] / np.maximum(line_stats[:, 0], 1)
    out["dup_line_char_share"] = line_stats[:, 2] / whole
    good = ~out["base_failed"] & (out["dup_line_char_share"] <= LINE_CHAR_LIMIT)
    for n, limit in limits.items():
        at = np.nonzero(repeated(words, doc, n, first=False))[0]
        chars = np.array([len(flat[i]) if flat[i].isascii() else len(flat[i].decode("utf-8", "surrogatepass")) for i in at.tolist()], np.float64)
        share = np.bincount(doc[at], weights=chars, minlength=count) / whole if len(at) else np.zeros(count)
        out[f"dup_{n}gram_share"] = share
        good &= share <= limit
    out["kept"] = good
    return out


_EACH_WHITE = [_WHITE[i : i + 1] for i in range(len(_WHITE))]
_EACH_SYMBOL = [SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))]


def _lines(raw: bytes) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, and the characters in the words of the latter."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = len(lines) - len(set(lines))
    if not again:
        return len(lines), 0, 0
    chars = sum((many - 1) * _word_chars(line) for line, many in Counter(lines).items() if many > 1)
    return len(lines), again, chars


def _word_chars(raw: bytes) -> int:
    return (len(raw) if raw.isascii() else len(raw.decode("utf-8", "surrogatepass"))) - sum(map(raw.count, _EACH_WHITE))


def report(docs: DataFrame, *, text: str = "text", key: str = "doc_id", limits: Mapping[int, float] = NGRAM_LIMITS) -> DataFrame:
    """One row per document: (key, counts, shares, base_failed, kept). Narrow: no shuffle."""
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shares = ("dup_line_share", "dup_line_char_share", *(f"dup_{n}gram_share" for n in limits))
    names = [key, *longs, "base_failed", "kept", *shares]
    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"{key} {kind}", *(f"{c} long" for c in longs), "base_failed boolean", "kept boolean", *(f"{c} double" for c in shares)])

    def run(batches):
        for b in batches:
            parts = [measure(block, limits) for block in blocks(texts_of(b, text))]
            if parts:
                yield pa.RecordBatch.from_arrays([b.column(key), *[pa.array(np.concatenate([p[c] for p in parts])) for c in names[1:]]], names=names)

    return docs.select(key, text).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, *, text: str = "text", limits: Mapping[int, float] = NGRAM_LIMITS) -> DataFrame:
    """The documents that pass, with all their columns."""
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            texts = [t if t is not None else "" for t in b.column(at).to_pylist()]
            kept = [measure(block, limits)["kept"] for block in blocks(texts)]
            if kept:
                yield b.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
