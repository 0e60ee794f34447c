"""Property tests: extractors vs Python re, chunker vs its closed form.

Each hypothesis example is a batch of texts evaluated in ONE Spark job, so a
few examples cover many inputs. The alphabet avoids U+001C..U+001F, which
Python counts as whitespace and Java does not (a documented difference).
"""
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regloom.operators import chunks as C
from regloom.operators import extract as X
from tests.test_extract import py_facts

TOKENS = [
    "G2067", "G2079", "G2060", "G0137", "G1234", "H0020", "H2010", "F11.20", "F11.2X", "Z59.01", "Z55.0x", "Z66.1",
    "at least", "minimum of", "nine", "Twelve", "2", "15", "1500", "service", "services", "distinct", "per", "every",
    "in a", "7-day", "7 day", "minute", "minutes", "min", "counseling", "therapy", "session", "take-home", "unsupervised",
    "dose", "medication", "modifier", "HF", "POS-58", "place of service 58", "HD", "HG", "polysubstance", "alcohol use",
    "benzodiazepine", "thnsp;", "[ Grab your reader's attention ]", "é", "ü", "😀", "word",
]
SEPS = [" ", "  ", "\n", "\n\n", "\n \n", "\t", " ", "\r\n", ", ", ". ", "-", ""]

text = st.lists(st.tuples(st.sampled_from(TOKENS), st.sampled_from(SEPS)), max_size=40).map(
    lambda parts: "".join(t + s for t, s in parts)
)


@settings(max_examples=8, deadline=None)
@given(st.lists(text, min_size=1, max_size=40))
def test_extractors_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    rows = df.select(
        "i",
        X.iop_threshold(t).alias("iop"), X.weekly_min_services(t).alias("weekly"), X.cms_g_codes(t).alias("g"),
        X.any_g_codes(t).alias("gany"), X.any_h_codes(t).alias("h"), X.f11_codes(t).alias("f11"),
        X.sdoh_z_codes(t).alias("z"), X.counseling_minutes(t).alias("mins"), X.polysubstance_hits(t).alias("poly"),
        X.mentions_take_home(t).alias("takehome"), X.hf_flag(t).alias("hf"), X.pos58_flag(t).alias("pos"),
        X.hd_hg_flag(t).alias("hdhg"), X.strip_template(t).alias("strip"), X.clean_ecfr(t).alias("ecfr"),
    ).collect()
    for r in rows:
        got = r.asDict()
        assert got.pop("i") is not None
        assert got == py_facts(texts[r.i]), repr(texts[r.i])


#: Paragraphs have neither blank lines nor white space around them; whatever stands between them is a gap.
paragraph = st.lists(st.sampled_from([t for t in TOKENS if t.strip() == t]), min_size=1, max_size=25).flatmap(
    lambda words: st.lists(st.sampled_from([" ", "  ", "\n", "\t", ", "]), min_size=len(words) - 1, max_size=len(words) - 1).map(
        lambda seps: words[0] + "".join(s + w for s, w in zip(seps, words[1:], strict=True))
    )
)
gap = st.sampled_from(["\n\n", "\n \n", "\n\t \n\n", "\r\n\r\n", "  \n\n  "])
edge = st.sampled_from(["", "\n", "  ", "\n\n \n"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.lists(paragraph, max_size=5), gap, edge), min_size=1, max_size=20), st.integers(2, 60), st.integers(0, 59))
def test_chunks_in_closed_form(spark, docs, size, overlap):
    stride = size - overlap % size
    texts = [before + between.join(paragraphs) + before for paragraphs, between, before in docs]
    units = spark.createDataFrame([(i, "src", "lab", t) for i, t in enumerate(texts)], "doc_id int, source_key string, label string, text string")
    rows = C.explode_windows(C.paragraph_units(units), size=size, overlap=size - stride).collect()
    got = {(r.doc_id, r.unit_ord, r.window_ord): (r.text, r.chunk_id) for r in rows}
    assert len(got) == len(rows)
    want = {}
    for i, (paragraphs, _, _) in enumerate(docs):
        for u, p in enumerate(paragraphs):
            count = 1 + max(0, -(-(len(p) - size) // stride))
            for w in range(count):
                piece = p[w * stride : w * stride + size]
                want[i, u, w] = piece, hashlib.sha256(f"src|lab|{piece}".encode()).hexdigest()[:16]
    assert got == want
