"""Operator 9: near-duplicates by SetSketch registers.

A document's set holds the 64-bit hashes of its distinct word shingles. Equal
sets form a class, which has a number and stands for its smallest key. For a class the sketch
keeps, per register, the smallest of the elements' hashes as an exponential
variate, rounded down to powers of ``BASE`` and truncated: sketches of parts
merge by the register-wise maximum, and registers of two sets agree more often
the more similar the sets are.

1. Bands: ``ROWS`` registers form a band; classes that agree in a whole band
   share a bucket. At similarity 0.8, a pair shares none of the 32 bands with
   a probability of 3e-6. The full sets of the classes that share a bucket are
   written once, and everything below works on them.
2. Candidates: a bucket's members are compared with its first member, not
   with each other, so a bucket of n classes gives n - 1 pairs.
3. Likelihood: the registers of a pair that are larger on the left, larger on
   the right and equal have known probabilities given both set sizes and the
   similarity; the similarity of greatest likelihood must not lie more than six
   standard errors below the threshold.
4. Verification on the full sets decides about every remaining pair.
5. Members outside the component of another, random member of their bucket
   are compared with that one, which joins nearly all of a large group.
6. Buckets that still hold members of different components are settled by an
   exact join: with all shingles in one order, rare ones first, two sets that
   are similar enough share one of the first (1 - t) * size + 1 of each, and at
   the first that they share enough is left in both. Only pairs of different
   components that meet so are verified, however many members a bucket has.
   So no link between classes that share a bucket is lost, whatever the
   likelihood gave up before.

Null and word-free texts have the empty set and are linked with nothing; a
text of fewer words than a shingle is one shingle. Repeated rows fall into one
class; rows that share a key but not a text count as linked (their classes
are, each verified by its own set). Rows without a
key stay, with a null component, and are not kept. Only the key and text
columns are read. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.llm.bpe import texts_of
from regloom.llm.components import components
from regloom.llm.repetition import mixed, rolling
from regloom.session import written

BANDS, ROWS = 32, 5
#: Base of the exponential spacing and largest register value.
BASE, TOP = 1.001, 65_535
#: The sketch may fall short of the threshold by so many standard errors before a pair is given up unverified.
ERRORS = 6.0


@dataclass(frozen=True)
class Rule:
    """Link sets with ``100 * intersection >= percent * union``; shingles of ``words`` words."""

    words: int = 5
    percent: int = 80


class WordHash(dict):
    """64-bit hashes of words; bounded, so that memory doesn't follow the data."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 400_000:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = WordHash()


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes (ASCII upper case folded, words cut at ASCII white space)."""
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, split), np.uint64, len(split))
    return np.unique(rolling(hashes, min(words, len(split))))


_rng = np.random.Generator(np.random.PCG64(20240229))
#: Multipliers and offsets of the registers' hash functions, and of the band keys (fixed by the seed).
_MUL = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64)
_BAND_MUL = _rng.integers(0, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.integers(0, 2**63, BANDS, np.uint64)
#: Rate of the exponential variates: puts the registers of sets of 1 to 1e20 elements inside the range.
_RATE = math.exp(8)
#: Shingles hashed for all registers at once (a megabyte or so of products).
_AT_ONCE = 1024


def registers(elements: np.ndarray) -> np.ndarray:
    """SetSketch registers of one nonempty set."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), _AT_ONCE):
        low = np.minimum(low, (elements[i : i + _AT_ONCE, None] * _MUL + _ADD).min(axis=0))
    variate = -np.log1p(-((low >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / _RATE
    return np.clip(np.floor(1 - np.log(variate) / math.log(BASE)), 0, TOP).astype("<u2")


def band_keys(sketch: np.ndarray) -> np.ndarray:
    return mixed((sketch.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MUL).sum(axis=1, dtype=np.uint64) + _BAND_ADD).view(np.int64)


def sketch(docs: DataFrame, rule: Rule, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (id, n, class, registers, bands); class, registers and bands are null for the empty set."""

    def run(batches):
        for b in batches:
            n, group, regs, bands = [], [], [], []
            for t in texts_of(b, text):
                s = shingle_set(t, rule.words)
                n.append(len(s))
                if len(s):
                    k = registers(s)
                    group.append(class_of(s))
                    regs.append(k.tobytes())
                    bands.append(band_keys(k).tolist())
                else:
                    group.append(None), regs.append(None), bands.append(None)
            cols = [b.column(key), pa.array(n, pa.int64()), pa.array(group, pa.binary()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "class", "registers", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"id {kind}, n long, class binary, registers binary, bands array<long>")


def likelihood_estimate(more: np.ndarray, less: np.ndarray, equal: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Similarity of greatest likelihood for pairs of sketches with known set sizes, on a grid of 1/200."""
    u = (n1 / (n1 + n2))[:, None]
    v = 1 - u
    j = np.minimum(np.linspace(0, 1, 201)[None, :], np.minimum(u / v, v / u))
    chance = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)
    p_more, p_less = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
    log = lambda p: np.log(np.maximum(p, 1e-12))
    score = more[:, None] * log(p_more) + less[:, None] * log(p_less) + equal[:, None] * log(1 - p_more - p_less)
    return j[np.arange(len(u)), np.argmax(score, axis=1)]


def _likely(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, na, nb) whose jointly estimated similarity doesn't rule a link out."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("registers").alias(f"r{x}"))
    goal = rule.percent / 100
    least = goal - ERRORS * math.sqrt(goal * (1 - goal) / (BANDS * ROWS))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(b.num_rows, -1) for c in ("ra", "rb"))
            more, less = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
            na, nb = (b.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
            kept = likelihood_estimate(more, less, ra.shape[1] - more - less, na, nb) >= least
            yield b.select(["a", "b", "na", "nb"]).filter(pa.array(kept))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, na long, nb long")


#: Bits of the filter over candidates' keys: sixteen for each key, within these bounds (16 MB at most).
FILTER_BITS = (1 << 16, 1 << 27)


def _marked(wanted: DataFrame) -> tuple[int, object]:
    """(bits, broadcast array of 64-bit words): a bit for each key's hash. It keeps
    most other documents from being shingled again; whatever passes is joined."""
    low, high = FILTER_BITS
    bits = min(high, max(low, 1 << (16 * wanted.count()).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = wanted.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("mark")).toArrow()
    marks = np.zeros(bits >> 6, np.uint64)
    marks[words["word"].to_numpy()] = words["mark"].to_numpy().view(np.uint64)
    return bits, wanted.sparkSession.sparkContext.broadcast(marks)


def class_of(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _sets(wanted: DataFrame, docs: DataFrame, rule: Rule, text: str, key: str) -> DataFrame:
    """Rows (node, n, elements) of the wanted classes (node, class, id): the full set of each, once.

    Its text is found by the class's key; where that key has several texts,
    the one that gives the class is taken.
    """
    bits, marks = _marked(wanted)

    def run(batches):
        for b in batches:
            at = b.column("bit").to_numpy()
            b = b.filter(pa.array((marks.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0))
            sets = [shingle_set(t, rule.words) for t in texts_of(b, "t")]
            cols = [pa.array([class_of(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["class", "n", "elements"])

    texts = docs.where(F.col(key).isNotNull()).select(F.col(text).alias("t"), F.pmod(F.xxhash64(key), F.lit(bits)).alias("bit"))
    found = texts.mapInArrow(run, "class binary, n long, elements binary")
    return written(found.join(wanted.select("node", "class"), "class").dropDuplicates(["node"]).select("node", "n", "elements"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) that are linked, by their full sets."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("elements").alias(f"s{x}"))

    def compare(batches):
        for b in batches:
            linked = []
            for x, y in zip(b.column("sa"), b.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def _sized(x: str, y: str, rule: Rule) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * rule.percent


def _key_links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each key that has several."""
    several = rows.groupBy("id").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("id", "low")
    pairs = rows.select("id", "class").join(several, "id").where("class != low").select("low", "class").distinct()
    node = lambda c, name: classes.select(F.col("class").alias(c), F.col("node").alias(name))
    return pairs.join(node("low", "a"), "low").join(node("class", "b"), "class").select("a", "b")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: (key, n_shingles, component_id, kept, class_id).

    class_id is the smallest key of the equal sets, component_id the smallest
    key reachable over links; one document of each component is kept.
    """
    sketched = written(sketch(docs, rule, text=text, key=key), "sketch")
    some = sketched.where("class is not null")
    keyed = some.where("id is not null")
    body = F.struct("n", "registers", "bands")
    numbered = keyed.groupBy("class").agg(F.min("id").alias("id"), F.min_by(body, "id").alias("body")).select(F.monotonically_increasing_id().alias("node"), "class", "id", "body.*")
    classes = written(numbered, "classes")
    # Buckets of two classes or more, with their first member.
    members = classes.select(F.explode("bands").alias("bucket"), "node", "n")
    heads = written(
        members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket", "head"), "buckets"
    )
    shared = written(members.join(heads, "bucket").select("bucket", F.col("head.node").alias("a"), F.col("head.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")), "members")
    wanted = written(classes.select("node", "class", "id").join(shared.select(F.col("b").alias("node")).distinct(), "node", "left_semi"), "wanted")
    sets = _sets(wanted, docs, rule, text, key)
    first = shared.where("a != b").where(_sized("na", "nb", rule)).select("a", "b", "na", "nb").distinct()
    links = written(_verified(_likely(first, classes, rule), sets, rule).unionByName(_key_links(keyed, classes)), "verified")
    roots = written(components(links), "stars")
    for pairs_of in (lambda p: _likely(_other_heads(p, rule), classes, rule), lambda p: _open_pairs(p, sets, rule)):
        pairs = written(pairs_of(_placed(shared, roots)), "pairs")
        if pairs.take(1):
            joined = roots.select(F.col("node").alias("a"), F.col("component").alias("b"))
            roots = written(components(joined.unionByName(_verified(pairs, sets, rule))), "stars")
    at = classes.select("node", "class", F.col("id").alias("class_id")).join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = at.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = written(at.join(smallest, "component").select("class", "class_id", "component_id"), "named")
    placed = some.select("id", "n", "class").join(named, "class", "left")
    alone = sketched.where("class is null").select("id", "n", F.lit(None).cast("binary").alias("class"), F.col("id").alias("class_id"), F.col("id").alias("component_id"))
    return placed.select("id", "n", "class", "class_id", "component_id").unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"), "class_id"
    )


def _placed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket members (bucket, b, nb) with their component."""
    root = roots.select(F.col("node").alias("b"), "component")
    return written(shared.join(root, "b", "left").select("bucket", "b", "nb", F.coalesce("component", "b").alias("component")), "placed")


def _other_heads(placed: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a random member of each bucket and the members outside its component.

    Each class is in 32 buckets and so meets as many members of its group,
    which joins nearly all of a large group of near copies.
    """
    heads = written(placed.groupBy("bucket").agg(F.min_by(F.struct("b", "nb", "component"), F.xxhash64("b", "bucket")).alias("x")), "heads")
    met = placed.join(heads, "bucket").where(F.col("component") != F.col("x.component")).where(_sized("nb", "x.nb", rule))
    return met.select(F.col("x.b").alias("a"), "b", F.col("x.nb").alias("na"), "nb").distinct()


#: Cells of the table that orders shingles by how many open sets hold them.
CELLS = 1 << 18


def _open_pairs(placed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, among the members of buckets that hold several components."""
    mixed_buckets = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("bucket")
    members = placed.join(mixed_buckets, "bucket").select(F.col("b").alias("node"), "component").distinct()
    open_ = written(sets.join(members, "node").select("node", "n", "component", "elements"), "open")

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            for x in b.column("elements"):
                total += np.bincount((np.frombuffer(x.as_buffer(), np.uint64) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "many"])

    rarity = np.zeros(CELLS, np.uint64)
    table = open_.select("elements").mapInArrow(count, "cell long, many long").groupBy("cell").agg(F.sum("many").alias("many")).toArrow()  # CELLS rows at most
    rarity[table["cell"].to_numpy()] = table["many"].to_numpy().astype(np.uint64)
    held = placed.sparkSession.sparkContext.broadcast(rarity)

    def prefixes(batches):
        for b in batches:
            nodes, sizes, groups, shingles, places = [], [], [], [], []
            for node, component, x in zip(b.column("node").to_pylist(), b.column("component").to_pylist(), b.column("elements"), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                n = len(x)
                first = n + (-rule.percent * n // 100) + 1  # n - ceil(percent * n / 100) + 1
                x = x[np.lexsort((x, held.value[(x & np.uint64(CELLS - 1)).astype(np.int64)]))][:first]
                nodes.append(np.full(len(x), node)), sizes.append(np.full(len(x), n)), groups.append(np.full(len(x), component))
                shingles.append(x.view(np.int64)), places.append(np.arange(len(x)))
            if nodes:
                cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in (shingles, nodes, sizes, groups, places)]
                yield pa.RecordBatch.from_arrays(cols, names=["shingle", "node", "n", "component", "at"])

    entries = open_.select("node", "component", "elements").mapInArrow(prefixes, "shingle long, node long, n long, component long, at long")
    side = lambda s: entries.select("shingle", *[F.col(c).alias(s + c) for c in ("node", "n", "component", "at")])
    # At the first shared shingle, this one and what follows in the shorter rest must reach the needed overlap.
    left = F.least(F.col("xn") - F.col("xat"), F.col("yn") - F.col("yat"))
    enough = left * (100 + rule.percent) >= rule.percent * (F.col("xn") + F.col("yn"))
    met = side("x").join(side("y"), "shingle").where((F.col("xnode") < F.col("ynode")) & (F.col("xcomponent") != F.col("ycomponent")) & enough & _sized("xn", "yn", rule))
    return met.select(F.col("xnode").alias("a"), F.col("ynode").alias("b")).distinct()
