"""Operators 9 and 10, components, the pipeline and the entry point."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from regloom.llm import chat, components, kd_shards, line_join, packing, repetition, setsketch
from regloom.llm.queries import BYTE_BPE, QUERIES
from tests.llm.data import SCHEMA, documents, frame, near_components, removed_lines, shingles


@pytest.fixture(scope="module")
def rows():
    return documents()


def family(n: int, seed: int = 2) -> list[tuple]:
    """Near copies of one text (a few words changed in each) and unlike texts."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(200)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(200)] = f"x{rnd.randint(0, 10**6)}"
        out.append((i, " ".join(words), "en", "s", 0, "", ""))
    return out + [(n + i, " ".join(f"y{rnd.randint(0, 10**6)}" for _ in range(60)), "en", "s", 0, "", "") for i in range(20)]


@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80)])
def test_near_duplicates(spark, rows, words, percent):
    got = setsketch.near_duplicates(frame(spark, rows), setsketch.Rule(words, percent)).collect()
    texts = {r[0]: r[1] for r in rows}
    want = near_components(texts, words, percent)
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(shingles(texts[i], words)), want[i], want[i] == i), texts[i]


def test_large_family_of_near_copies(spark):
    rows = family(150)
    want = near_components({r[0]: r[1] for r in rows}, 2, 80)
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(frame(spark, rows), setsketch.Rule(2, 80)).collect()}
    assert got == want


def model_pairs(sets, components, percent):
    return {
        (a, b) for a in sets for b in sets
        if a < b and components[a] != components[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize("percent", [80, 60])
def test_open_buckets_give_every_pair_that_may_be_linked(spark, percent):
    """Members of one bucket, many of them alike just below and just above the threshold, some in one component already."""
    rnd = np.random.default_rng(3)
    core = rnd.integers(0, 2**63, 300, np.uint64)
    sets, components = {}, {}
    for i in range(120):
        own = rnd.integers(0, 2**63, rnd.integers(20, 60), np.uint64)
        sets[i] = np.unique(np.concatenate((rnd.choice(core, rnd.integers(200, 300), replace=False), own)))
        components[i] = i if i % 10 else 0
    sets[200], sets[201] = sets[5][:-30], sets[5][: len(sets[5]) * percent // 100]
    components |= {200: 200, 201: 201}
    placed = spark.createDataFrame([(7, i, len(x), components[i]) for i, x in sets.items()], "bucket long, b long, nb long, component long")
    full = spark.createDataFrame([(i, len(x), bytearray(x.tobytes())) for i, x in sets.items()], "node long, n long, elements binary")
    rule = setsketch.Rule(2, percent)
    want = model_pairs({i: set(x.tolist()) for i, x in sets.items()}, components, percent)
    pairs = setsketch._open_pairs(placed, full, rule)
    assert want <= {(r["a"], r["b"]) for r in pairs.collect()}
    assert {(r["a"], r["b"]) for r in setsketch._verified(pairs, full, rule).collect()} == want and len(want) > 2


def test_family_alike_just_below_the_threshold(spark):
    """No two of these are linked, though all share buckets; two true links hide among them."""
    rnd = random.Random(6)
    base = [f"w{rnd.randint(0, 10**9)}" for _ in range(300)]
    texts = []
    for _ in range(90):
        words = list(base)
        for k in rnd.sample(range(300), 18):
            words[k] = f"x{rnd.randint(0, 10**9)}"
        texts.append(words)
    texts += [[*texts[40][:-3], "one", "more"], [*texts[70], "last"]]
    rows = [(i, " ".join(t), "en", "s", 0, "", "") for i, t in enumerate(texts)]
    want = near_components({r[0]: r[1] for r in rows}, 2, 80)
    assert 60 < len(set(want.values())) < len(texts)
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(frame(spark, rows), setsketch.Rule(2, 80)).collect()}
    assert got == want


def test_rows_that_share_a_key_link_their_texts(spark):
    rnd = random.Random(4)
    a, b = ([f"{c}{rnd.randint(0, 10**9)}" for _ in range(100)] for c in "ab")
    near = lambda t: " ".join([*t[:99], "changed"])
    rows = [(1, " ".join(a)), (5, near(a)), (5, " ".join(b)), (9, near(b)), (12, "something else entirely here"), (12, None), (13, " ".join(reversed(b)))]
    docs = frame(spark, [(*r, "en", "s", 0, "", "") for r in rows])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(docs, setsketch.Rule(2, 80)).collect())
    assert got == [(1, 99, 1, True), (5, 99, 1, False), (5, 99, 1, False), (9, 99, 1, False), (12, 0, 12, True), (12, 3, 12, True), (13, 99, 13, True)]


def test_truncated_copies_in_a_large_family(spark):
    rnd = random.Random(5)
    base, other = ([f"{c}{rnd.randint(0, 10**9)}" for _ in range(401)] for c in "wv")
    texts = [base]
    for _ in range(80):
        words = list(base)
        words[rnd.randrange(401)] = f"x{rnd.randint(0, 10**9)}"
        texts.append(words)
    texts += [base[:399], base[:320], other] + [other[: 4 * k + 1] for k in range(75, 100)]
    rows = [(i, " ".join(t), "en", "s", 0, "", "") for i, t in enumerate(texts)]
    want = near_components({r[0]: r[1] for r in rows}, 2, 80)
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(frame(spark, rows), setsketch.Rule(2, 80)).collect()}
    assert got == want


def test_near_duplicates_odd_keys(spark, rows):
    odd = [(None, *rows[0][1:]), (None, None, *rows[0][2:]), rows[0], rows[0]]
    got = setsketch.near_duplicates(frame(spark, odd)).collect()
    assert len(got) == 4 and sum(r["kept"] for r in got) == 2
    assert setsketch.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_merge_and_estimate():
    rnd = np.random.default_rng(4)
    pool = rnd.integers(0, 2**63, 3000, np.uint64)
    a, b = pool[:2000], pool[500:3000]
    assert (np.maximum(setsketch.registers(a[:700]), setsketch.registers(a[700:])) == setsketch.registers(a)).all()
    ra, rb = setsketch.registers(a), setsketch.registers(b)
    more, less = (np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]))
    found = setsketch.likelihood_estimate(more, less, len(ra) - more - less, np.array([2000.0]), np.array([2500.0]))[0]
    assert abs(found - 1500 / 3000) < 0.12


def test_components(spark):
    rnd = random.Random(9)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, None)]
    root = {x: x for e in links if None not in e for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_line_dedup(spark, rows):
    rows = rows[:-1] + [(1000 + i, "\n".join(f"{a} shared passage of many words that copies have in common {b}" for b in range(4)), "", "", 0, "", "") for i, a in enumerate("uvwxyz")]
    texts = {r[0]: r[1] for r in rows}
    want = removed_lines(texts)
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in line_join.report(docs).collect()}
    assert {i: r["removed_lines"] for i, r in got.items()} == want
    assert all(r["n_lines"] == len((texts[i] or "").split("\n")) and r["n_removed"] == len(want[i]) for i, r in got.items())
    left = line_join.drop_lines(docs)
    assert left.columns == docs.columns
    cleaned = {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in want[i]) if want[i] else t for i, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {i: t for i, t in cleaned.items() if not want[i] or re.search("[^\x20\x09-\x0D]", t)}
    assert line_join.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_line_dedup_family(spark):
    rows = [(r[0], r[1], *r[2:]) for r in family(120, seed=8)]
    got = {r["doc_id"]: r["removed_lines"] for r in line_join.report(frame(spark, rows)).collect()}
    assert got == removed_lines({r[0]: r[1] for r in rows})


def test_line_dedup_meets_words_in_jobs(spark, monkeypatch):
    """Each job shuffles the entries of its own words only; their number changes no line."""
    rows = [(i, "\n".join(f"w{i // 3} w{i // 3 + j} " + " ".join(f"t{(i // 2) * 7 + k + j * 31}" for k in range(14)) + f" x{i}" for j in range(3))) for i in range(40)]
    docs, want = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), removed_lines(dict(rows))
    assert any(want.values())
    plain = line_join.written
    for passes in (1, 3):
        tags = []
        monkeypatch.setattr(line_join, "PASSES", passes)
        monkeypatch.setattr(line_join, "written", lambda df, tag: tags.append(tag) or plain(df, tag))
        assert {r["doc_id"]: r["removed_lines"] for r in line_join.report(docs).collect()} == want
        assert tags.count("met") == passes


def test_line_parities_tell_long_lines_apart(spark):
    """Lines of 180 words that share none are no candidates; those that share enough always are."""
    sets = [[f"{a}{i}" for i in range(180)] for a in "abcdef"] + [[f"a{i}" for i in range(n, n + 180)] for n in (1, 10, 20)]
    bodies = spark.createDataFrame([(n, " ".join(ws)) for n, ws in enumerate(sets)], "i long, body string")
    found = bodies.select("i", F.sort_array(line_join._hashes(F.col("body"))).alias("h")).select("i", F.size("h").alias("n"), line_join._parity("h", 0).alias("odd0"), line_join._parity("h", 1).alias("odd1"))
    side = lambda s: found.select(*[F.col(c).alias(s + c) for c in found.columns])
    close = {(r["xi"], r["yi"]) for r in side("x").join(side("y"), F.col("xi") < F.col("yi")).where(line_join._close("x", "y", 80)).collect()}
    similar = {(x, y) for x in range(len(sets)) for y in range(x + 1, len(sets)) if 100 * len(set(sets[x]) & set(sets[y])) >= 80 * len(set(sets[x]) | set(sets[y]))}
    assert similar and similar <= close
    assert not {(x, y) for x, y in close if y < 6}


def test_line_dedup_of_short_lines(spark, tmp_path):
    short = ["buy now", "Buy now", "now buy now buy", "buy", "BUY", "", " ", "one two three", "three two  one", "one two three four", "buy now today"]
    rows = [(i, "\n".join([f"start{i}", *short[i % 3 :], f"{i} end", short[i]]), "", "", 0) for i in range(len(short))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = removed_lines({r[0]: r[1] for r in rows}, least=1)
    assert {r["doc_id"]: r["removed_lines"] for r in line_join.report(docs, min_words=1).collect()} == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["removed_lines"] for r in QUERIES["op10_line_dedup"][0](spark, str(tmp_path)).collect()} == want
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert left == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i]) for i, t, *_ in rows}


def test_line_dedup_null_and_shared_keys(spark):
    """Key 1 has the line first; documents A and B have one key (none, or 5), and B's line 0 repeats it."""
    old, own = "a line that was here before", "some other line of this document only"
    for k in (None, 5):
        a = "\n".join(["first words of document a alone", own + " a x y", "the end of a comes here"])
        b = "\n".join([old, "what only b has to say in its second"])
        head = -1 if k else None
        docs = spark.createDataFrame([(head, old), (k, a), (k, b), (k, b)], "doc_id long, text string").repartition(3)
        got = sorted((r["n_lines"], r["removed_lines"]) for r in line_join.report(docs).collect())
        kept = [r["text"] for r in line_join.drop_lines(docs).collect()]
        if k:
            assert got == [(1, []), (2, [0]), (3, [])]
            assert sorted(kept) == sorted([old, a, b.split("\n")[1], b.split("\n")[1]])
        else:  # without keys, either place of the line may count as the first; the line stays once, the others untouched
            assert sorted(n for n, _ in got) == [1, 2, 3] and sum(len(x) for _, x in got) == 1
            assert a in kept and all(b.split("\n")[1] in x for x in kept if x not in (a, old))


def test_pipeline_against_brute_force(spark, rows, tmp_path):
    some = [r[:5] for r in rows[:-1]] + [r[:5] for r in family(30)]
    some = [(i, *r[1:4], None if r[1] is None else len(r[1])) for i, r in enumerate(some)]
    spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] or "" for r in some}
    kept = repetition.measure(list(texts.values()))["kept"]
    texts = {i: t for (i, t), k in zip(texts.items(), kept, strict=True) if k}
    gone = removed_lines(texts)
    texts = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if re.search("[^\x20\x09-\x0D]", t)}
    root = near_components(texts, 5, 80)
    texts = {i: t for i, t in texts.items() if root[i] == i}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from tests.llm.test_tokens import check_packing

    check_packing(got, texts, packing.TIERS)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    assert BYTE_BPE


def test_pipeline_copies_with_null_and_shared_keys(spark):
    rnd = random.Random(11)
    a, b, c = (" ".join(f"{x}{rnd.randint(0, 10**6)}" for _ in range(80)) for x in "abc")
    rows = [(None, a), (None, a), (3, a + " more"), (3, b), (7, b), (7, b), (2, c), (2, c), (None, c), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, _extra long").repartition(3)
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    # Key 3 comes before no key, so its near copy of a stays; its other text and key 2's repeated row stay too.
    assert got == sorted([(3, a + " more"), (3, b), (2, c), (2, c), (None, None), (4, "")], key=str)
    keyless = docs.where("doc_id is null and text is not null")
    assert sorted(r["text"] for r in corpus_pipeline.near_duplicates(spark, keyless, "").collect()) == sorted([a, a, c])


def test_native_operators_run_no_python(spark, rows):
    docs = frame(spark, rows)
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    for df in (line_join.report(docs), line_join.drop_lines(docs), kd_shards.kd_shards(docs, shards=5), chat.digests(formatted), chat.expand(formatted, contexts=True)):
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", df._jdf.queryExecution().executedPlan().toString())


def test_entry_registers_every_operator():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and {*QUERIES, "pipeline"} <= set(names)
    assert "op3_stupid_backoff" in __spark_entry__.oracle_sql()


def test_lone_columns(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert setsketch.near_duplicates(docs).where(F.col("kept")).count() == 2


def test_bit_filter_is_no_literal_of_the_plan(spark):
    from regloom.llm import line_join

    ids = spark.range(0, 500, 5).withColumnRenamed("id", "num")
    found = spark.range(20_000).withColumnRenamed("id", "num").where(line_join._among(ids, "num"))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 5_000
    got = {r["num"] for r in found.collect()}
    assert got >= set(range(0, 500, 5)) and len(got) < 200


def test_shuffle_files_go_with_a_written_table(spark):
    from regloom.session import SHUFFLE_CLEANUP, shuffles_removed, written

    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    table = written(spark.range(100).groupBy("id").count(), "cleaned")
    assert table.count() == 100 and table.count() == 100
