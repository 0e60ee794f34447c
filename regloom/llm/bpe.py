"""Operator 5: byte-pair encoding and decoding with a segment tree.

Each word's adjacent symbol pairs are the leaves of a segment tree whose nodes
hold the smallest ``rank * leaves + position`` below them, so the root names
the leftmost pair of the lowest rank. A merge changes three leaves (the pair
itself, its left neighbour, the swallowed right one); each is a point update
up the tree, and merging ends when the root holds no mergeable pair. Trees of
equal size are kept as rows of one numpy array and advance together, a few
megabytes at a time, so one word of a million symbols and a million short
words both cost (merges x log length).

Texts are cut at single spaces into chunks that the vocabulary's splitting
pattern never joins, and each worker remembers the encodings of the chunks it
met last (a bounded cache), so the tree runs once for each different word.

Semantics are those of the tokenizers library with add_special_tokens=False:
special strings inside a text become their special token; no truncation or
padding. A null text is the empty text; an empty text has no tokens. Rows are
independent: repeated rows give equal results, extra columns are ignored by
``encode`` unless named in ``keep``.
"""
from __future__ import annotations

import gc
import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from regloom.llm.vocab import Vocab, load

NONE = np.iinfo(np.int64).max
#: Leaves that are merged at once: the trees (two 8-byte nodes and three 4-byte links a leaf) stay in the CPU's cache.
LEAVES_AT_ONCE = 1 << 17
#: Chunks a worker remembers before it starts anew, and the longest that is remembered.
CACHE_CHUNKS, CACHE_CHUNK_CHARS = 500_000, 64


def pair_lookup(vocab: Vocab, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, merged symbol) of each pair; rank -1 where the pair never merges."""
    keys = left * vocab.size + right
    at = np.minimum(np.searchsorted(vocab.pairs, keys), len(vocab.pairs) - 1)
    hit = vocab.pairs[at] == keys
    return np.where(hit, vocab.ranks[at], -1), vocab.made[at]


def _merge_rows(vocab: Vocab, sym: np.ndarray, length: np.ndarray) -> None:
    """Merge every row of ``sym`` (rows x leaves, -1 beyond each length) in place; merged-away symbols become -1."""
    rows, leaves = sym.shape
    place = np.arange(leaves, dtype=np.int64)
    nxt = np.broadcast_to(np.arange(1, leaves + 1, dtype=np.int32), sym.shape).copy()
    prv = np.broadcast_to(np.arange(-1, leaves - 1, dtype=np.int32), sym.shape).copy()
    tree = np.full((rows, 2 * leaves), NONE, dtype=np.int64)
    made = np.zeros((rows, leaves), dtype=np.int32)
    if leaves > 1:
        live = place[None, :-1] + 1 < length[:, None]
        r, c = np.nonzero(live)
        rank, out = pair_lookup(vocab, sym[r, c], sym[r, c + 1])
        ok = rank >= 0
        tree[r[ok], leaves + c[ok]] = rank[ok] * leaves + c[ok]
        made[r[ok], c[ok]] = out[ok]
    width = leaves
    while width > 1:
        tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
        width //= 2

    def set_leaf(r: np.ndarray, c: np.ndarray, value: np.ndarray) -> None:
        node = c + leaves
        tree[r, node] = value
        while True:
            node = node >> 1
            if node.size == 0 or node[0] == 0:
                return
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    def renew(r: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
        rank, out = pair_lookup(vocab, sym[r, c], sym[r, d])
        made[r, c] = out
        set_leaf(r, c, np.where(rank >= 0, rank * leaves + c, NONE))

    active = np.nonzero(tree[:, 1] < NONE)[0]
    while active.size:
        at = tree[active, 1] % leaves
        right = nxt[active, at].astype(np.int64)
        after = nxt[active, right].astype(np.int64)
        sym[active, at] = made[active, at]
        sym[active, right] = -1
        nxt[active, at] = after
        set_leaf(active, right, np.full(active.size, NONE))
        inner = after < length[active]
        ra, aa, fa = active[inner], at[inner], after[inner]
        prv[ra, fa] = aa
        renew(ra, aa, fa)
        ro, ao = active[~inner], at[~inner]
        set_leaf(ro, ao, np.full(ro.size, NONE))
        before = prv[active, at].astype(np.int64)
        has = before >= 0
        renew(active[has], before[has], at[has])
        active = active[tree[active, 1] < NONE]


def encode_words(vocab: Vocab, words: list[bytes]) -> list[bytes]:
    """Token ids of each word (one pre-token's bytes each), as little-endian unsigned 32-bit numbers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    symbols = vocab.first[flat]
    filled = lengths > 0
    ends = (starts + lengths - 1)[filled]
    symbols[ends] = vocab.last[flat[ends]]
    out = [b""] * len(words)
    sizes = np.ones(len(words), np.int64)
    while (small := sizes < lengths).any():
        sizes[small] *= 2
    for leaves in np.unique(sizes[filled]):
        group = np.nonzero(filled & (sizes == leaves))[0]
        step = max(1, int(LEAVES_AT_ONCE // leaves))
        for i in range(0, len(group), step):
            some = group[i : i + step]
            place = np.arange(leaves)[None, :]
            inside = place < lengths[some][:, None]
            sym = np.full(inside.shape, -1, np.int64)
            sym[inside] = symbols[(starts[some][:, None] + place)[inside]]
            _merge_rows(vocab, sym, lengths[some])
            left = sym >= 0
            packed = sym[left].astype("<u4").tobytes()
            ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
            for k, lo, hi in zip(some.tolist(), [0, *ends], ends, strict=False):
                out[k] = packed[lo:hi]
    return out


def lowered(text: str) -> str:
    """Lower case character by character, without the rule for a final sigma."""
    return text.replace("Σ", "σ").lower()


def pre_tokens(vocab: Vocab, chunk: str) -> list[str]:
    """The pre-tokens of a chunk. Letters only, after a space or not, are one by any of the patterns; a comma or stop after them is another."""
    if chunk.isascii():
        body = chunk[1:] if chunk[:1] == " " else chunk
        if body.isalpha():
            return [chunk.lower() if vocab.lowercase else chunk]
        if body[-1:] in (",", ".") and body[:-1].isalpha():
            return [chunk[:-1].lower() if vocab.lowercase else chunk[:-1], chunk[-1]]
    if vocab.lowercase:
        chunk = lowered(chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk))
    return vocab.pattern.findall(chunk)


#: White space other than the space, by code point.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")
_CUT = regex.compile(r"(?<=\S)(?= \S)")


def chunks(vocab: Vocab, text: str) -> list[str]:
    """Cut a special-free text where the splitting pattern always starts a new pre-token.

    A space between two characters that are not white space is such a place:
    the space either begins the next pre-token or is dropped. Texts in which a
    space touches other white space are cut by a scan for exactly those places.
    """
    touching = "  " in text or any(c in text and (c + " " in text or " " + c in text) for c in _BLANKS)
    if vocab.drop_unmatched:
        return [x.strip(" ") for x in _CUT.split(text)] if touching else text.split(" ")
    if touching or "\0" in text:
        return _CUT.split(text)
    return text.replace(" ", "\0 ").split("\0")


class ChunkCache(dict):
    """Encodings of chunks as values made by ``value(list of packed ids)``; bounded, so memory doesn't follow the data."""

    def __init__(self, vocab: Vocab, value):
        super().__init__()
        self.vocab, self.value = vocab, value

    def learn(self, missing: Iterable[str]) -> dict[str, object]:
        """Encode chunks not yet known; returns those too long to keep."""
        todo, value = list(missing), self.value
        split = [pre_tokens(self.vocab, c) for c in todo]
        distinct = list({w for ws in split for w in ws})
        known = dict(zip(distinct, self.encode([w.encode("utf-8", "surrogatepass") for w in distinct]), strict=True))
        long = {}
        for c, ws in zip(todo, split, strict=True):
            (self if len(c) <= CACHE_CHUNK_CHARS else long)[c] = value([known[w] for w in ws])
        return long

    def encode(self, words: list[bytes]) -> list[bytes]:
        return encode_words(self.vocab, words)

    def texts(self, texts: list[str]) -> Iterator[list]:
        """For each text the values of its chunks and special tokens, in order."""
        vocab, parted = self.vocab, []
        gc.disable()  # nothing here makes cycles, and the collector would walk all these lists
        for text in texts:
            parts = vocab.special_split.split(text) if vocab.special_split and any(s in text for s in vocab.specials) else [text]
            parted.append([(p in vocab.specials and i % 2 == 1, p if i % 2 else chunks(vocab, p)) for i, p in enumerate(parts)])
        new = set()
        for parts in parted:
            for special, p in parts:
                if not special:
                    new.update(p)
        if len(self) > CACHE_CHUNKS:
            held = {c: self[c] for c in new if c in self}  # what the current block uses stays
            self.clear()
            self.update(held)
        long = self.learn(new.difference(self))
        gc.enable()
        get = self.__getitem__ if not long else lambda c: long[c] if c in long else self[c]
        for parts in parted:
            if len(parts) == 1:
                yield list(map(get, parts[0][1]))
            else:
                yield [v for special, p in parts for v in ([self.value([np.array([vocab.specials[p]], "<u4").tobytes()])] if special else map(get, p))]


#: Code points whose encodings are worked on together.
TEXT_BLOCK = 1 << 20


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts, about a megabyte at a time (at least one)."""
    some, n = [], 0
    for t in texts:
        some.append(t)
        n += len(t)
        if n >= TEXT_BLOCK:
            yield some
            some, n = [], 0
    if some:
        yield some


_CACHES: dict[tuple, ChunkCache] = {}


def cache_for(path: str, kind: str, value, make=ChunkCache) -> ChunkCache:
    """One cache per worker, vocabulary and kind of value: workers are reused by later tasks."""
    if (path, kind) not in _CACHES:
        _CACHES[path, kind] = make(load(path), value)
    return _CACHES[path, kind]


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (``keep``..., ids array<int>): the token ids of every whole text."""
    fields = [docs.schema[c] for c in keep]
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([*fields, StructField("ids", ArrayType(IntegerType()))])

    def run(batches):
        cache = cache_for(path, "ids", b"".join)
        for b in batches:
            ids = [np.frombuffer(b"".join(vs), "<u4").astype(np.int32) for block in blocks(texts_of(b, text)) for vs in cache.texts(block)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            for lo, hi in _slices(ends):
                col = pa.ListArray.from_arrays(pa.array(ends[lo : hi + 1] - ends[lo], pa.int32()), pa.array(flat[ends[lo] : ends[hi]]))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(lo, hi - lo) for c in keep], col], names=[*keep, "ids"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def _slices(ends: np.ndarray, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` ids (or one row)."""
    lo, n = 0, len(ends) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def decode(encoded: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (``keep``..., text): the text of every ``ids`` array, as decode(ids, skip_special_tokens=False) gives it.

    A file without a decoder joins token strings by one space; a byte-level
    file joins their bytes and reads them as UTF-8 (bad bytes replaced). A
    null ids array gives the empty text.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*[encoded.schema[c] for c in keep], StructField("text", StringType())])

    def run(batches):
        vocab = load(path)
        for b in batches:
            got = pa.array([decode_ids(vocab, ids or []) for ids in b.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], got], names=[*keep, "text"])

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def decode_ids(vocab: Vocab, ids: Iterable[int]) -> str:
    strings = [vocab.tokens[i] for i in ids]
    if vocab.drop_unmatched:
        return " ".join(strings)
    parts = [vocab.word_bytes(s) if s not in vocab.specials else None for s in strings]
    return b"".join(p if p is not None else s.encode() for p, s in zip(parts, strings, strict=True)).decode("utf-8", "replace")


def round_trip_digests(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and decode every whole text in one pass, keeping digests instead of the ids and texts.

    Returns (key, n_tokens, ids_sha256, decoded_sha256). A chunk's encoding is
    kept as its count, its decimal ids and its decoded token strings, so a
    text's digests need no arrays of its length in Python objects.
    """
    vocab = load(path)
    if not vocab.drop_unmatched:
        raise ValueError("digests in one pass need a vocabulary that decodes token by token")

    def value(parts):
        v = load(path)
        ids = np.frombuffer(b"".join(parts), "<u4").tolist()
        return len(ids), " ".join(map(str, ids)).encode(), decode_ids(v, ids).encode("utf-8", "surrogatepass")

    def run(batches):
        cache = cache_for(path, "round trip", value)
        for b in batches:
            n, ids, back = [], [], []
            for block in blocks(texts_of(b, text)):
                for vs in cache.texts(block):
                    vs = [v for v in vs if v[0]]
                    n.append(sum(v[0] for v in vs))
                    ids.append(hashlib.sha256(b" ".join([v[1] for v in vs])).hexdigest())
                    back.append(hashlib.sha256(b" ".join([v[2] for v in vs])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
