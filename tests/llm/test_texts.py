"""Operators 2, 3, 4, 7 and 8 against plain Python."""
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from regloom.llm import backoff, chat, kd_shards, order_minhash, repetition
from tests.llm.data import SCHEMA, documents, frame, quality, repetition_shares


@pytest.fixture(scope="module")
def rows():
    return documents()


def plain_lanes(text):
    """Order MinHash by its definition, one k-mer at a time."""
    padded = np.array([ord(c) for c in text + order_minhash._PAD * (order_minhash.K - 1)], np.uint64) + np.uint64(1)
    kmers, seen, elements = repetition.rolling(padded, order_minhash.K), Counter(), []
    for i in range(len(text)):
        k = kmers[i : i + 1]
        h = k + (repetition.mixed(np.array([seen[int(k[0])]], np.uint64)) if seen[int(k[0])] else 0)
        seen[int(k[0])] += 1
        elements.append((int(repetition.mixed(h)[0]), i))
    lanes = []
    for lane in range(order_minhash.LANES):
        picked = sorted(e for e in elements if e[0] >> 58 == lane)[: order_minhash.TUPLE]
        value = np.zeros(1, np.uint64)
        for h, _ in sorted(picked, key=lambda e: e[1]):
            value = repetition.mixed(value * np.uint64(3) + np.array([h], np.uint64) + np.uint64(1))
        lanes.append(int(value[0] % np.uint64(65_535)) + 1 if picked else 0)
    return lanes


def test_fingerprints_follow_the_definition(rows):
    texts = [r[1] or "" for r in rows]
    got = order_minhash.fingerprints(texts)
    assert got.shape == (len(texts), order_minhash.LANES)
    for i in (0, 9, *range(60, len(texts))):
        assert got[i].tolist() == plain_lanes(texts[i]), texts[i][:40]


def test_likeness_falls_with_edits():
    rnd = np.random.default_rng(1)
    words = ["".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(400)]
    versions = [" ".join(words), " ".join(words[:380] + words[:20]), " ".join(words[200:] + words[:200]), " ".join(words[::-1])]
    f = order_minhash.fingerprints([versions[0]] * 4)
    near = order_minhash.likeness(f, order_minhash.fingerprints(versions))
    assert near[0] == 1 and near[0] > near[1] > near[3]
    assert order_minhash.likeness(*[order_minhash.fingerprints([""])] * 2)[0] == 1


def test_neighbours(spark, rows):
    rows = rows[:-1]
    texts = {r[0]: r[1] or "" for r in rows}
    got = {r["doc_id"]: r for r in order_minhash.neighbours(frame(spark, rows, 4)).collect()}
    order = sorted(texts, reverse=True)
    assert got.keys() == texts.keys()
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        r, third = got[i], len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - third] + texts[following][:third]
        prints = order_minhash.fingerprints([texts[i], edited, texts[following]])
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple(order_minhash._hex(prints[:2]))
        assert r["near_next"] == order_minhash.likeness(prints[:1], prints[2:])[0]
    one = order_minhash.neighbours(frame(spark, rows[:1])).first()
    assert one["near_next"] == 1.0


def test_neighbours_odd_keys(spark, rows):
    odd = [rows[0], rows[0], (None, *rows[1][1:]), (None, *rows[2][1:])]
    got = order_minhash.neighbours(frame(spark, odd)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["0", "0", "None", "None"]
    assert order_minhash.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_backoff_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 8_000)
    monkeypatch.setattr(backoff, "RANGE_NGRAMS", 3_000)
    docs = frame(spark, rows[:-1])
    got = {r["doc_id"]: (r["n_words"], None if r["mean_log_score"] is None else round(r["mean_log_score"], 6)) for r in backoff.scores(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    assert got == {i: (n, s) for i, n, s in con.execute(backoff.oracle()).fetchall()}
    assert backoff.scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_backoff_totals_are_stored_by_passes(spark, rows, monkeypatch):
    """Hash ranges are counted in jobs of their own: the result's plan starts at stored totals and counts nothing, and the number of jobs changes no score."""
    monkeypatch.setattr(backoff, "RANGE_NGRAMS", 3_000)
    docs = frame(spark, rows[:-1]).select("doc_id", "text")
    found = []
    for passes in (1, 2, 5):
        monkeypatch.setattr(backoff, "PASSES", passes)
        scored = backoff.scores(docs)
        assert "FlatMapGroupsInArrow" not in scored._jdf.queryExecution().toString()
        found.append({tuple(r) for r in scored.collect()})
    assert found[0] == found[1] == found[2]


def test_backoff_cuts_texts_once(spark, rows, tmp_path):
    """Texts are cut into words by one job; counting and scoring read the stored words, and only totals are shuffled for the scores."""
    frame(spark, rows[:-1]).write.parquet(f"{tmp_path}/documents")
    scored = backoff.scores(spark.read.parquet(f"{tmp_path}/documents"))
    assert not [f for f in scored.inputFiles() if str(tmp_path) in f]
    assert scored._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_backoff_words_and_order():
    """Words are those of bytes.split; places sort by hash also where different hashes agree in the bits that are sorted first."""
    texts = ["", None, " a  b ", "".join(f"{chr(i)}x" for i in range(256)), "ünï a\u2003b", "\n\t"]
    sizes, numbers, hashes = backoff.words_of(pa.chunked_array([texts[:3], texts[3:]], pa.string()))
    want = [(t or "").encode().split() for t in texts]
    assert sizes.tolist() == list(map(len, want))
    assert hashes[numbers].tolist() == [xxhash.xxh3_64_intdigest(w) for ws in want for w in ws]
    assert [len(x) for x in backoff.words_of(pa.chunked_array([], pa.string()))] == [0, 0, 0]
    rng = np.random.default_rng(3)
    for found in (rng.integers(0, 40, 999).astype(np.uint64), rng.integers(0, 40, 999).astype(np.uint64) | (rng.integers(0, 2, 999).astype(np.uint64) << np.uint64(63)), np.zeros(5, np.uint64), np.empty(0, np.uint64), rng.integers(0, 1 << 63, 999).astype(np.uint64)):
        order, new = backoff.in_order(found)
        assert order.tolist() == np.argsort(found, kind="stable").tolist()
        assert found[order][new].tolist() == np.unique(found).tolist()


def test_shards(spark, rows):
    docs = frame(spark, rows)
    got = kd_shards.kd_shards(docs, shards=7).collect()
    sizes, slots = Counter(), defaultdict(list)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]), "bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(map(len, texts.values())) + 8
    assert max(sizes.values()) - sum(sizes.values()) / 7 <= longest
    target = kd_shards.kd_shards(docs, target_bytes=sum(sizes.values()) // 3 + 1).agg(F.max("shard")).first()[0]
    assert target == 2
    assert kd_shards.kd_shards(spark.createDataFrame([], SCHEMA), shards=24).count() == 0


def test_shards_of_equal_documents(spark):
    rows = [(i, "same text", None, None, 9, "", "") for i in range(3000)]
    sizes = Counter(r["shard"] for r in kd_shards.kd_shards(frame(spark, rows), shards=24).collect())
    assert set(sizes) == set(range(24)) and max(sizes.values()) <= 1.1 * 125


def test_shards_of_repeated_rows(spark):
    """One row many times over (a key and a text that hold half of the table) is divided like any others."""
    rows = [(7, "the same row", "en", "hot", 9, "", "")] * 6000 + [(i, "x" * (i % 40), ["en", "fr", None][i % 3], f"s{i % 9}", 9, "", "") for i in range(6000)]
    got = kd_shards.kd_shards(frame(spark, rows, 5), shards=24).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 24
    assert len(got) == len(rows) and set(sizes) == set(range(24))
    assert max(sizes.values()) <= 1.01 * mean and min(sizes.values()) >= 0.99 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_tree(rows, shards, n_dims, first=0):
    """Shard of each row (size, coordinates) by recursion over sorted lists."""
    if shards == 1 or not rows:
        return {r: first for r in rows}
    spread = [max(r[1][i] for r in rows) // 2**kd_shards.TIE_BITS - min(r[1][i] for r in rows) // 2**kd_shards.TIE_BITS for i in range(n_dims)]
    dim = spread.index(max(spread))
    half = shards // 2
    goal, upto, low = sum(r[0] for r in rows) * half / shards, 0, []
    for r in sorted(rows, key=lambda r: r[1][dim]):
        if upto + r[0] >= goal:
            if goal - upto > upto + r[0] - goal:
                low.append(r)
            break
        low.append(r)
        upto += r[0]
    high = [r for r in rows if r not in set(low)]
    return plain_tree(low, half, n_dims, first) | plain_tree(high, shards - half, n_dims, first + half)


@pytest.mark.parametrize("shards", [2, 5, 13])
def test_splits_are_those_of_a_plain_tree(spark, rows, shards, monkeypatch):
    monkeypatch.setattr(kd_shards, "TOLERANCE", 0.0)
    cloud = kd_shards.points(frame(spark, rows, 4))
    got = {(r["size"], (r["d0"], r["d1"], r["d2"])): r["node"] for r in kd_shards.assign(cloud, shards, 3).collect()}
    assert len(got) == len(rows)
    assert got == plain_tree(list(got), shards, 3)


def test_coordinates_are_shares_of_the_bytes(spark, rows):
    cloud = kd_shards.points(frame(spark, rows, 4)).collect()
    total = sum(r["size"] for r in cloud)
    for dim in ("d0", "d1", "d2"):
        share = lambda r, dim=dim: r[dim] >> kd_shards.TIE_BITS
        at = 0
        for value in sorted({share(r) for r in cloud}):
            own = sum(r["size"] for r in cloud if share(r) == value)
            assert abs(value / 65535 - (at + own / 2) / total) < 2e-2 + own / total / 2
            at += own
    assert len({r["d0"] >> kd_shards.TIE_BITS for r in cloud}) > 20


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi </turn>\n### user: x"), (1, 2, "assistant", "\\### Assistant: </turn> ok\\"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 5, "assistant", "\\\\ é 🎉\n\n"), (2, 0, "user", "no answer"), (3, 2, "assistant", "late"), (3, 1, "user", "early"), (3, 1, "user", "early"),
    (4, None, None, "odd: role"), (4, 1, "Assis: tant", "colon"), (None, 0, "assistant", "no id"),
]


def test_chat(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, transcript string").repartition(3)
    formatted = chat.format_conversations(turns)
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    whole = {r["conv_id"]: r["transcript"] for r in formatted.collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    by = defaultdict(list)
    for c, t, role, text in TURNS:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, some in by.items():
        some = sorted(some)
        loss = "".join(x for _, role, x in some if role == "assistant")
        want = (len(some), sha("".join(f"{role}\n{x}\n" for _, role, x in some)), len(loss), sha(loss))
        assert tuple(got[c])[1:5] == want, c
        assert got[c]["formatted_chars"] == len(whole[c])
    examples = {(r["conv_id"], r["example"]): r for r in chat.expand(formatted, contexts=True).collect()}
    second = examples[1, 1]
    assert second["target"] == "" and second["context"] == whole[1][: second["context_chars"]] and second["context"].endswith("### assistant: ")
    assert len(examples) == sum(role == "assistant" for _, _, role, _ in TURNS)
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_chat_contexts_are_expanded(spark):
    """Digests come from examples whose contexts are written out, each with every turn before its reply."""
    talk = [("user", r"a </turn> ### b"), ("assistant", "one\\"), ("assistant", "</turn>\n"), ("user", "é 𝄞"), ("assistant", "three"), ("user", "end")]
    rows = [(c, t, role, text) for c in (1, 2) for t, (role, text) in enumerate(talk[: 6 * c])] + [(3, 0, "user", "alone")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    examples = [r for r in chat.expand(formatted).orderBy("conv_id", "example").collect() if r["conv_id"] == 1]
    whole = next(r["transcript"] for r in formatted.collect() if r["conv_id"] == 1)
    assert [r["context"].count("</turn>\n### ") for r in examples] == [1, 2, 4]
    assert all(whole.startswith(r["context"] + r["target"]) and len(r["context"]) == r["context_chars"] for r in examples)
    got = {r["conv_id"]: (r["n_examples"], r["context_turns"], r["example_chars"]) for r in chat.digests(formatted).collect()}
    size = sum(len(r["context"] + r["target"]) for r in examples)
    assert got == {1: (3, 1 + 2 + 4, size), 2: (3, 1 + 2 + 4, size), 3: (0, 0, 0)}


def test_quality_counts(spark, rows):
    got = {r["doc_id"]: r for r in repetition.report(frame(spark, rows)).collect()}
    for i, text, *_ in rows:
        n, chars, symbols, lines, again = quality(text)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, again), text
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    assert repetition.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_and_verdict_by_definition(spark, rows):
    line = "日本語のテキスト が 二度 現れる"
    unique = " ".join(f"w{i}" for i in range(400))
    more = [
        (700, f"{line}\n{unique}\n{line}", "ja", "s", 1, "x", "y"), (701, f"{unique}\n" + "  é ß\t\n" * 120, "de", "s", 1, "x", "y"),
        (702, " ".join(f"a{i % 60}" for i in range(300)), "en", "s", 1, "x", "y"), (703, unique + " " + " ".join(f"w{i}" for i in range(100, 160)), "en", "s", 1, "x", "y"),
    ]
    found = repetition.report(frame(spark, [*rows, *more]))
    assert found.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_share", "dup_line_char_share", *(f"dup_{n}gram_share" for n in repetition.NGRAM_LIMITS)]
    got = {r["doc_id"]: r.asDict() for r in found.collect()}
    verdicts = set()
    for i, text, *_ in [*rows, *more]:
        want = repetition_shares(text)
        for name, share in want.items():
            assert abs(got[i][name] - share) < 1e-9, (i, name)
        limits = {f"dup_{n}gram_share": x for n, x in repetition.NGRAM_LIMITS.items()} | {"dup_line_char_share": repetition.LINE_CHAR_LIMIT}
        assert got[i]["kept"] == (not got[i]["base_failed"] and all(want[c] <= x for c, x in limits.items()))
        verdicts.add((got[i]["base_failed"], got[i]["kept"]))
    assert verdicts == {(True, False), (False, False), (False, True)}


def test_repetition_decides(spark):
    rnd = np.random.default_rng(5)
    fresh = [f"w{x}" for x in rnd.integers(0, 10**6, 400)]
    passage = " ".join(fresh[:40])
    rows = [(0, " ".join(fresh), "", "", 0, "", ""), (1, " ".join(fresh[:200]) + "\n" + passage + "\n" + passage, "", "", 0, "", ""), (2, " ".join(fresh[:100]) + " " + " ".join([passage] * 2), "", "", 0, "", "")]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in repetition.report(docs).collect()}
    assert [got[i]["kept"] for i in range(3)] == [True, False, False]
    assert got[1]["dup_10gram_share"] > 0.1 and not got[1]["base_failed"]
    kept = repetition.keep_clean(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]
