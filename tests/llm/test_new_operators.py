"""Operators 11 to 13 against the libraries and brute force."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regloom.llm import alignment, libraries, spellings, token_files
from regloom.llm.queries import BYTE_BPE, PIECE_BPE
from tests.llm.data import SCHEMA, documents, frame


@pytest.fixture(scope="module")
def rows():
    return documents()


# operator 11


def parquet_files(folder):
    return sorted(folder.glob("ids/*.parquet"))


def test_token_files(spark, rows, tmp_path):
    rows = [*rows, (None, "no key", "en", "s", 6, "x", "y"), (None, None, "en", "s", None, "x", "y"), (7, "another text of key 7", "en", "s", 1, "x", "y")]
    token_files.write(frame(spark, rows, 5), BYTE_BPE, str(tmp_path))
    got = token_files.read(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter((r[0], tuple([*library.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += r["n_tokens"]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys)
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in token_files.digests(token_files.read(spark, str(tmp_path))).collect()}
    assert crc == {(r["doc_id"], r["start"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}


def test_token_files_layout_and_selective_reads(spark, rows, tmp_path):
    many = spark.range(6000).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("some words of text "), F.repeat(F.col("id").cast("string"), 30)).alias("text"))
    token_files.write(many, BYTE_BPE, str(tmp_path), row_group_bytes=1 << 16, page_bytes=1 << 12, page_rows=100)
    groups, encodings = 0, defaultdict(set)
    for f in parquet_files(tmp_path):
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                encodings[column.path_in_schema] |= set(column.encodings)
    assert groups > 2 * len(parquet_files(tmp_path))
    assert any("DICTIONARY" in e for e in encodings["ids.list.element"])
    assert all("DELTA_BINARY_PACKED" in encodings[c] for c in ("doc_id", "part", "at"))
    table = token_files.read(spark, str(tmp_path))
    some = table.where("doc_id in (300, 9000)")
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan or "In(doc_id, [300,9000])" in plan
    assert [r["doc_id"] for r in some.orderBy("doc_id").collect()] == [300, 9000]
    assert "ids" not in table.select("doc_id", "start")._jdf.queryExecution().executedPlan().toString().split("ReadSchema", 1)[1]
    stream = [i for r in table.orderBy("start").collect() for i in r["ids"]]
    for lo, hi in ((0, 1), (17, 4000), (len(stream) - 5, len(stream) + 10), (70_000, 70_001)):
        span = token_files.read_span(spark, str(tmp_path), lo, hi).orderBy("start").collect()
        assert [i for r in span for i in r["ids"]] == stream[lo:hi] and span[0]["start"] == lo
    assert token_files.read_span(spark, str(tmp_path), len(stream), len(stream) + 1).count() == 0


def test_token_files_split_a_hot_key(spark, tmp_path):
    hot = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    token_files.write(hot, BYTE_BPE, str(tmp_path))
    parts = spark.read.parquet(f"{tmp_path}/ids").groupBy("part").count().collect()
    assert sum(r["count"] for r in parts) == 4000
    assert token_files.read(spark, str(tmp_path)).select("start").distinct().count() == 4000


def test_long_texts_are_cut_without_a_trace(rows):
    texts = [r[1] for r in rows if r[1]]
    library, sp = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert libraries.pieces_start_words(PIECE_BPE)
    for most in (1, 7, 100):
        for t in texts:
            parts = libraries.cut(t, most)
            assert "".join(parts) == t
            assert [i for p in parts for i in library.encode(p, add_special_tokens=False).ids] == library.encode(t, add_special_tokens=False).ids
            assert [i for k, p in enumerate(parts) for i in sp.encode(p[1:] if k else p)] == sp.encode(t)


def test_ids_are_those_of_the_tokenizers_library(rows):
    import random

    rnd = random.Random(2)
    library = Tokenizer.from_file(BYTE_BPE)
    odd = ["<|endoftext|>", "<|endoftext|", "'ll", "'S", " ", "  ", "\t", "\n", "\r\n", "\u00a0", "\u2028", "\u0301", "\u200d", "é", "ß", "ẞ", "中", "文字", "½", "٣", "🎉", "👩‍👧", "a", "B", "12", "_", "--", "\x00", "\x1f", "\ufffd", "\U0010ffff"]
    texts = [r[1] or "" for r in rows] + ["".join(rnd.choice(odd) for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(50)) for _ in range(300)]
    assert [x.tolist() for x in libraries.encode_bytes(BYTE_BPE, texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    library.encode_special_tokens = True
    assert [x.tolist() for x in libraries.encode_bytes(BYTE_BPE, texts, True)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


# operator 12


def model_alignment(texts):
    """Per key (n_a, n_b, n_groups, n_links, groups text, linked pairs), one byte at a time."""
    library, sp = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    library.encode_special_tokens = True
    from regloom.llm.vocab import byte_chars

    back = {c: b for b, c in byte_chars().items()}
    out = {}
    for k, t in texts.items():
        want = (" " + (t or "")).encode()
        a = [(i, bytes(back[c] for c in library.id_to_token(i))) for i in library.encode(" " + (t or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()) for i in sp.encode(t or "") for p in [sp.id_to_piece(i)]]
        if not t or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            out[k] = (0, 0, 0, 0, "", [])
            continue
        ends = [{}, {}]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, raw in tokens:
                at += len(raw)
                ends[side][at] = i
        both = sorted(ends[0].keys() & ends[1].keys())
        groups = ["|".join(",".join(str(s[e]) for e in sorted(s) if lo < e <= hi) for s in ends) for lo, hi in zip([0, *both], both, strict=False)]
        out[k] = (len(a), len(b), len(both), len(both), ";".join(groups), [(ends[0][e], ends[1][e]) for e in both])
    return out


def test_alignment(spark, rows):
    rows = [*rows[:-1], (900, "▁ odd ▁▁piece", "en", "s", 1, "x", "y"), (901, "  two  spaces   three ", "en", "s", 1, "x", "y"), (902, "</s><s> <unk> <0x41>", "en", "s", 1, "x", "y")]
    want = model_alignment({r[0]: r[1] for r in rows})
    counts = Counter(p for x in want.values() for p in x[5])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    got = {r["doc_id"]: r for r in alignment.alignment_report(frame(spark, rows, 4), BYTE_BPE, PIECE_BPE).collect()}
    assert got.keys() == want.keys()
    for k, (n_a, n_b, n_groups, n_links, text, pairs) in want.items():
        r = got[k]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (n_a, n_b, n_groups, n_links), rows[k][1]
        assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if n_a else "")
        assert (r["n_best"], r["count_sum"]) == (sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs))
    assert got[900]["n_a"] == 0 and got[901]["n_a"] > 0


def test_groups_of_an_alignment(spark, rows):
    want = model_alignment({r[0]: r[1] for r in rows})
    got = alignment.align(frame(spark, rows[:-1], 3), BYTE_BPE, PIECE_BPE).collect()
    assert len(got) == len(rows) - 1
    for r in got:
        a, b, groups = list(r["a_ids"]), list(r["b_ids"]), []
        for n, m in zip(r["a_sizes"], r["b_sizes"], strict=True):
            groups.append(",".join(map(str, a[:n])) + "|" + ",".join(map(str, b[:m])))
            a, b = a[n:], b[m:]
        assert (";".join(groups), a, b) == (want[r["doc_id"]][4], [], [])


def test_intervals():
    a, b = np.array([0, 2, 5, 6, 9]), np.array([0, 3, 4, 6, 7, 9])
    spans = a[:-1], a[1:], b[:-1], b[1:]
    assert [g.tolist() for g in alignment.coalesce(*spans)] == [[0, 0, 0, 1], [0, 0, 0, 1, 1]]
    want = {(i, j) for i in range(4) for j in range(5) if a[i] < b[j + 1] and b[j] < a[i + 1]}
    assert set(zip(*[x.tolist() for x in alignment.overlaps(*spans)], strict=True)) == want


def test_alignment_of_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert alignment.alignment_report(none, BYTE_BPE, PIECE_BPE).count() == 0
    empty = frame(spark, [(1, None, "en", "s", 0, "x", "y"), (None, "", "en", "s", 0, "x", "y")])
    assert [tuple(r)[1:] for r in alignment.alignment_report(empty, BYTE_BPE, PIECE_BPE).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


# operator 13


def model_words(rows, min_chars=7, min_count=2):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def model_variants(words, times=10):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def odd_words(seed=5):
    import random

    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 12))) for _ in range(60)] + ["aaaaaaaa", "abababab", "ÀÉÎÕÜßÿ", "x" * 300, "straße×÷ab"]
    out = []
    for k, w in enumerate(base):
        out += [w] * rnd.choice([1, 2, 25, 300])
        for _ in range(8):
            i, c = rnd.randrange(len(w) + 1), rnd.choice("abcéz")
            v = rnd.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
            out += [v] * rnd.choice([1, 2, 3, 20])
            if k % 3 == 0:
                out += [v[:i] + "q" + v[i:]] * 2
    rnd.shuffle(out)
    return [(i, " ".join(out[i * 40 : (i + 1) * 40]) + (" ABCABCABC.mixed-CASE" if i % 9 == 0 else ""), "en", "s", 1, "x", "y") for i in range(len(out) // 40 + 1)]


@pytest.mark.parametrize("most", [0, 12, 10**6])
def test_spelling_variants(spark, rows, most):
    rows = [*odd_words(), *rows, (None, "without a key keykeykey keykeykey keykeykeys keykeykeys", "en", "s", 1, "x", "y"), (5000, None, "en", "s", 1, "x", "y")]
    want = model_variants(model_words(rows))
    got = {r["word"]: tuple(r)[1:] for r in spellings.variants(frame(spark, rows, 4), most=most).collect()}
    assert got == want
    assert any(f and want[f][0] for f, *_ in want.values())  # a chain of two steps
    assert len({len(w) for w in want}) > 5


@pytest.mark.parametrize("spelled", [7, 9, 300])
def test_long_words_are_compared_by_name(spark, spelled):
    counts = model_words(odd_words(8))
    found = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = [(frozenset((r["a"], r["b"])), {r["a"]: r["a_n"], r["b"]: r["b_n"]}) for r in spellings.near_pairs(found, most=20, spelled=spelled).collect()]
    assert len(got) == len({p for p, _ in got}) and all(n == {w: counts[w] for w in p} for p, n in got)
    assert {p for p, _ in got} == {frozenset((a, b)) for a in counts for b in counts if a < b and one_edit(a, b)}


def test_every_place_leaves_a_gram():
    rnd = np.random.default_rng(1)
    for length in range(spellings.LEAST_CHARS, 14):
        c = rnd.integers(1, 4, (500, length))
        for share in (0.0, 0.3, 0.7, 1.0):
            gram, end, kept = spellings.decompose(c, rnd.random(spellings.SIZE**2) < share)
            p = np.arange(gram.shape[1])
            for i in range(-1, length + 1):
                assert (kept & ~((end - 3 <= i) & (p[None, :] + 2 >= i))).any(axis=1).all()


def test_no_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spellings.variants(none).count() == 0
    assert spellings.variants(frame(spark, [(1, None, "", "", 0, "", ""), (2, "short once", "", "", 0, "", "")])).count() == 0
    with pytest.raises(ValueError):
        spellings.variants(none, min_chars=5)
