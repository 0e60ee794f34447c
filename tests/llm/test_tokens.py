"""Operators 1, 5 and 6 against the tokenizers library."""
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from regloom.llm import bpe, packing, token_count
from regloom.llm.queries import BYTE_BPE, WORD_BPE
from regloom.llm.vocab import load
from tests.llm.data import SCHEMA, documents, frame


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return documents()


def encoded(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_counts(spark, rows):
    got = {r["doc_id"]: r for r in token_count.token_counts(frame(spark, rows), BYTE_BPE).collect()}
    texts = {r[0]: r[1] or "" for r in rows}
    for i, ids in zip(texts, encoded(BYTE_BPE, list(texts.values())), strict=True):
        assert (got[i]["n_bytes"], got[i]["n_tokens"]) == (len(texts[i].encode()), len(ids)), texts[i][:50]


def test_proven_words_are_one_token():
    vocab = load(BYTE_BPE)
    proven = sorted(token_count.prove_whole_tokens(vocab))
    assert len(proven) > 40_000
    assert all(len(ids) == 1 for ids in encoded(BYTE_BPE, proven[::97]))


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encode_decode(spark, rows, path):
    ids = bpe.encode(frame(spark, rows), path)
    texts = {r[0]: r[1] or "" for r in rows}
    want = dict(zip(texts, encoded(path, list(texts.values())), strict=True))
    assert {r["doc_id"]: r["ids"] for r in ids.collect()} == want
    library = Tokenizer.from_file(path)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(ids, path).collect()}
    assert back == {i: library.decode(x, skip_special_tokens=False) for i, x in want.items()}


def test_round_trip_digests(spark, rows):
    texts = {r[0]: r[1] or "" for r in rows}
    library = Tokenizer.from_file(WORD_BPE)
    want = {i: (len(x), sha(" ".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in zip(texts, encoded(WORD_BPE, list(texts.values())), strict=True)}
    got = bpe.round_trip_digests(frame(spark, rows), WORD_BPE).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


def test_segment_tree_takes_leftmost_lowest_rank():
    vocab, library = load(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    words = ["a" * n for n in (1, 2, 3, 7, 64, 65, 1000)] + ["abababab", "mississippi", "zzzyyyzzz"]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_words(vocab, [w.encode() for w in words])]
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_small_cache_gives_the_same(monkeypatch, rows):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(bpe, "CACHE_CHUNK_CHARS", 3)
    texts = [r[1] or "" for r in rows]
    cache = bpe.ChunkCache(load(BYTE_BPE), b"".join)
    got = [np.frombuffer(b"".join(vs), "<u4").tolist() for t in texts for vs in cache.texts([t])]
    assert got == encoded(BYTE_BPE, texts)


def check_packing(got, texts, tiers=packing.TIERS):
    ids = dict(zip(texts, (x + [packing.END_ID] for x in encoded(BYTE_BPE, list(texts.values()))), strict=True))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert pieces.keys() == texts.keys()
    for i, some in pieces.items():
        at = 0
        for r in sorted(some, key=lambda r: r["start"]):
            part = np.array(ids[i][at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[i]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[i])
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= some[0]["tier"] and (at == some[0]["tier"] or some[0]["tier"] == max(tiers))
        padding += 0 if at & (at - 1) == 0 else max(tiers) - at
    return padding, sum(map(len, ids.values()))


def test_packing(spark, rows):
    rows = rows[:-1]  # without the repeated row, whose pieces the model could not tell apart
    got = packing.pack(frame(spark, rows, 5), BYTE_BPE).collect()
    padding, tokens = check_packing(got, {r[0]: r[1] or "" for r in rows})
    assert padding < 0.02 * tokens + packing.TIERS[0]


@pytest.mark.parametrize("words", [600, 520, 700, 1023, 3])
def test_one_length_for_half_of_all_pieces(spark, words):
    """Hot lengths that fill no window: remainders are cut, next to nothing is padded."""
    texts = {i: " a" * (words - 1) for i in range(300)} | {1000 + i: " b" * (37 * i % 900) for i in range(200)}
    rows = [(i, t, "en", "s", 0, "x", "y") for i, t in texts.items()]
    padding, tokens = check_packing(packing.pack(frame(spark, rows, 6), BYTE_BPE).collect(), texts)
    assert padding <= packing.MAX_PADDING * tokens + packing.TIERS[0]


def test_repeated_rows_are_packed_twice(spark, rows):
    got = packing.pack(frame(spark, [rows[7], rows[7]]), BYTE_BPE).collect()
    assert sum(r["start"] == 0 for r in got) == 2


@pytest.mark.parametrize("histogram", [{}, {1: 5000}, {600: 1000}, {1023: 3, 1: 2, 512: 5}, {n: 3 for n in range(1, 1025)}, {n: 10**9 + n for n in range(1, 1025)}, {1024: 7}])
def test_plan_places_every_piece_once(histogram):
    lines, spans = packing.plan(histogram)
    for n, count in histogram.items():
        at = 0
        for x in sorted((x for x in lines if x.length == n), key=lambda x: x.lo):
            assert x.lo == at
            at += x.count
        assert at == count
    tokens = sum(n * count for n, count in histogram.items())
    top_first, top_many = spans[max(packing.TIERS)]
    held = sum(x.length * x.count for x in lines if x.tier == max(packing.TIERS))
    assert top_first == 0 and max(packing.TIERS) * top_many - held <= packing.MAX_PADDING * tokens + max(packing.TIERS)
    assert len(lines) < 20_000 and sum(s for _, s in spans.values()) <= sum(histogram.values())


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_count.token_counts(none, BYTE_BPE).count() == 0
    assert bpe.round_trip_digests(none, WORD_BPE).count() == 0
    assert packing.pack(none, BYTE_BPE).count() == 0
