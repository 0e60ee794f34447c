"""Operator 1: token counts with a whole-token shortcut.

Before any text is read, every string of the vocabulary is put through the
splitting pattern and the merges. Those that come back as one pre-token and
one token are proven: wherever a text's pre-token equals such a string, it
counts as one token without any merging. Only the other pre-tokens are merged
(batched, each different one once while it stays in the worker's bounded
cache). The proof is a table as large as the vocabulary, so it is broadcast.

Counts are those of the tokenizers library with add_special_tokens=False,
special strings inside a text counting as one token. A null text is the empty
text: 0 bytes and 0 tokens. Repeated rows give equal counts; other columns are
left aside, so they may have any names. An empty table gives no rows.
"""
from __future__ import annotations

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from regloom.llm import bpe
from regloom.llm.vocab import Vocab, load


def prove_whole_tokens(vocab: Vocab) -> frozenset[str]:
    """Vocabulary strings that, standing alone as a text, are one pre-token and one token."""
    texts = {}
    for token in vocab.ids:
        raw = vocab.word_bytes(token)
        if raw is not None and (s := raw.decode("utf-8", "replace")).encode() == raw:
            texts[token] = s
    alone = [s for s in texts.values() if bpe.pre_tokens(vocab, s) == [s] and s not in vocab.specials]
    return frozenset(s for s, ids in zip(alone, bpe.encode_words(vocab, [s.encode() for s in alone]), strict=True) if len(ids) == 4)


class CountCache(bpe.ChunkCache):
    """Counts of chunks: 1 for each proven pre-token, merges for the rest."""

    proven: frozenset[str] = frozenset()

    def learn(self, missing):
        todo, proven = list(missing), self.proven
        split = [bpe.pre_tokens(self.vocab, c) for c in todo]
        rest = list({w for ws in split for w in ws} - proven)
        merged = {w: len(ids) >> 2 for w, ids in zip(rest, self.encode([w.encode("utf-8", "surrogatepass") for w in rest]), strict=True)}
        long = {}
        for c, ws in zip(todo, split, strict=True):
            (self if len(c) <= bpe.CACHE_CHUNK_CHARS else long)[c] = sum([merged.get(w, 1) for w in ws])
        return long


def token_counts(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_bytes, n_tokens) for every whole text, in one pass without a shuffle."""
    spark = docs.sparkSession
    proven = spark.sparkContext.broadcast(prove_whole_tokens(load(path)))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        cache = bpe.cache_for(path, "count", lambda parts: sum(map(len, parts)) >> 2, CountCache)
        cache.proven = proven.value
        for b in batches:
            texts = bpe.texts_of(b, text)
            counts = [sum(vs) for block in bpe.blocks(texts) for vs in cache.texts(block)]
            sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(key), sizes, pa.array(counts, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long")
