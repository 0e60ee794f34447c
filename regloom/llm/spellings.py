"""Operator 13: spelling variants of words through a variable-length gram index.

Words are counted over all texts. Bigrams that more than LONG_LIST words hold
have long lists, so the gram dictionary gives them up for their trigrams; the
others stay. A word is decomposed by taking at every position the longest
dictionary gram and leaving out those inside an earlier one.

Whether the gram at p is in a decomposition depends only on the characters
from (its end - 3) to p + 2. So an edit at place i can affect only grams whose
stretch holds i, and two words one edit apart have all other grams in common,
behind the edit shifted by one. That bound is used for merging: the index
holds, for each word and each place, the words' whole list of unaffected grams
as one key, so that looking up a key merges all of their lists at once instead
of one gram after another. Words of six characters or more keep a gram at any
place (three positions at most are affected), so no list is empty. Words that
meet under a key are verified by edit distance.

A longer word's places stand for deletions, a shorter one's for insertions;
words of one length meet at the place of the replaced character.

Null texts have no words; a null key counts as the empty string in the hash
that deletes characters. Repeated rows count as often as they occur. Only key
and text are read, so other columns may have any names. Empty tables, and
tables without words that are long or frequent enough, give no rows. Long texts
are split in the JVM, a row per word.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regloom.session import written

#: A word's characters, and the smallest length and number of occurrences.
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, DELETE_EVERY, FORM_TIMES = 7, 2, 31, 10
#: Words on a bigram's list from which on trigrams are used, and the length from which every place leaves a gram.
LONG_LIST, LEAST_CHARS = 1000, 6
#: Longest words that index entries spell out, and entries made at a time.
SPELLED_CHARS, ENTRIES_AT_ONCE = 64, 1 << 16
#: Character codes: 1-26 for a-z, then U+00C0 to U+00FF; 0 is none.
SIZE = 1 + 26 + 64


def words(docs: DataFrame, *, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """Rows (word, n): maximal runs of letters, A-Z lower-cased, one character deleted where 31 divides the crc32 of key:run."""
    folded = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.explode(F.regexp_extract_all(folded, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))).alias("_run"))
    h = F.crc32(F.concat("_key", F.lit(":"), "_run").cast("binary"))
    at = F.col("_h") % F.length("_run")
    deleted = F.concat(F.substring(F.col("_run"), F.lit(1), at.cast("int")), F.substring(F.col("_run"), (at + 2).cast("int"), F.length("_run")))
    word = F.when(F.col("_h") % DELETE_EVERY == 0, deleted).otherwise(F.col("_run"))
    found = runs.withColumn("_h", h).select(word.alias("word")).where(F.length("word") >= min_chars)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _codes(batch: pa.RecordBatch, column: str = "word"):
    """The batch's words by length: (rows, matrix of character codes)."""
    texts = batch.column(column).to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    flat = np.where(flat >= 0xC0, flat - 0xC0 + 27, flat - 0x60)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.nonzero(lengths == length)[0]
        yield rows, flat[starts[rows][:, None] + np.arange(length)]


def long_lists(found: DataFrame, most: int = LONG_LIST) -> np.ndarray:
    """Bigram codes (first * SIZE + second) that more than ``most`` words hold: at most SIZE squared."""

    def run(batches):
        total = np.zeros(SIZE * SIZE, np.int64)
        for b in batches:
            for _, c in _codes(b):
                pairs = np.sort(c[:, :-1] * SIZE + c[:, 1:], axis=1)
                once = np.concatenate((np.ones((len(pairs), 1), bool), pairs[:, 1:] != pairs[:, :-1]), axis=1)
                total += np.bincount(pairs[once], minlength=SIZE * SIZE)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    lists = found.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return np.array(sorted(r["gram"] for r in lists.select("gram").collect()), np.int64)


def decompose(c: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, end, kept) of the gram at each position of words of one length: the trigram where the bigram's list is long."""
    pair = c[:, :-1] * SIZE + c[:, 1:]
    three = np.zeros(pair.shape, bool)
    if c.shape[1] > 2:
        three[:, :-1] = long[pair[:, :-1]]
    after = np.zeros(pair.shape, np.int64)
    after[:, :-1] = c[:, 2:]
    end = np.arange(pair.shape[1])[None, :] + 2 + three
    reach = np.maximum.accumulate(end, axis=1)
    kept = np.concatenate((np.ones((len(c), 1), bool), end[:, 1:] > reach[:, :-1]), axis=1)
    return np.where(three, pair * SIZE + after, pair), end, kept


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit mixing of whole numbers (a bijection)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unaffected(c: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the gram lists that edits leave alone: (words x length) for deletions at i, (words x length + 1) for insertions before i.

    Lists are keyed by the sum of their grams' mixed (gram, position), the
    length of the shorter word and the place. A key may meet another's by
    chance; meeting words are verified.
    """
    gram, end, kept = decompose(c, long)
    length, many = c.shape[1], gram.shape[1]
    p = np.arange(many)[None, :]
    three = kept & (end - p == 3)  # decided by end - 3 = p .. p + 2; a bigram by p - 1 .. p + 2
    here, there = (np.where(kept, _mixed((gram << 24) + p + shift), np.uint64(0)) for shift in (1, 0))  # in place, and shifted behind a deletion
    zero = np.zeros((len(c), 1), np.uint64)
    upto = np.concatenate((zero, np.cumsum(here, axis=1)), axis=1)

    def behind(v: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of the grams that are decided behind place ``at`` - 1: bigrams from at + 1 on, trigrams from at on."""
        total = np.concatenate((zero, np.cumsum(v, axis=1)), axis=1)
        rest = total[:, -1:] - total[:, np.minimum(at + 1, many)]
        own = np.concatenate((np.where(three, v, np.uint64(0)), zero), axis=1)
        return rest + own[:, np.minimum(at, many)]

    before = upto[:, np.clip(np.arange(length + 1) - 2, 0, many)]
    deleted = before[:, :length] + behind(there, np.arange(1, length + 1))
    inserted = before + behind(here, np.arange(length + 1))

    def keyed(sums: np.ndarray, shorter: int) -> np.ndarray:
        place = _mixed(np.arange(sums.shape[1], dtype=np.int64) + (np.int64(shorter) << 32))
        return _mixed(sums + place[None, :]).view(np.int64)

    return keyed(deleted, length - 1), keyed(inserted, length)


def index(found: DataFrame, long: np.ndarray) -> DataFrame:
    """Rows (list, word, n, shorter) from rows (letters, word, n): each word under the gram lists that an edit at any place leaves alone.

    ``word`` is what the entries call the word ``letters``.
    """
    held = found.sparkSession.sparkContext.broadcast(long)

    def run(batches):
        frequent = np.zeros(SIZE * SIZE, bool)
        frequent[held.value] = True
        for b in batches:
            for rows, c in _codes(b, "letters"):
                step = max(1, ENTRIES_AT_ONCE // c.shape[1])
                for i in range(0, len(rows), step):
                    for keys, shorter in zip(unaffected(c[i : i + step], frequent), (False, True), strict=True):
                        owner, flat = np.repeat(rows[i : i + step], keys.shape[1]), keys.reshape(-1)
                        for j in range(0, len(flat), ENTRIES_AT_ONCE):
                            at, some = pa.array(owner[j : j + ENTRIES_AT_ONCE]), pa.array(flat[j : j + ENTRIES_AT_ONCE])
                            yield pa.RecordBatch.from_arrays([some, b.column("word").take(at), b.column("n").take(at), pa.array(np.full(len(some), shorter))], names=["list", "word", "n", "shorter"])

    return found.select("letters", "word", "n").mapInArrow(run, "list long, word string, n long, shorter boolean")


def _met(entries: DataFrame) -> DataFrame:
    left = entries.where("not shorter").select("list", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = entries.select("list", F.col("word").alias("b"), F.col("n").alias("b_n"), "shorter")
    return left.join(right, "list").where(F.col("shorter") | (F.col("a") < F.col("b"))).select("a", "a_n", "b", "b_n")


def near_pairs(found: DataFrame, *, most: int = LONG_LIST, spelled: int = SPELLED_CHARS) -> DataFrame:
    """Rows (a, a_n, b, b_n): each pair of words that differ by one inserted, deleted or replaced character, once.

    Entries of words of up to ``spelled`` characters hold the word itself. A
    longer word has as many entries as characters; they hold its SHA-256, and
    the two words are fetched for verification when entries meet.
    """
    long = long_lists(found, most)
    near = F.levenshtein("a", "b", 1) == 1
    short = _met(index(found.where(F.length("word") <= spelled).select(F.col("word").alias("letters"), "word", "n"), long)).where(near)
    named = found.where(F.length("word") >= spelled).select(F.col("word").alias("letters"), F.sha2("word", 256).alias("word"), "n")
    names = named.select("letters", "word")
    pairs = _met(index(named, long)).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(names.select(F.col("word").alias(side), F.col("letters").alias(f"_{side}")), side)
    spelt = pairs.select(F.col("_a").alias("a"), "a_n", F.col("_b").alias("b"), "b_n").where(near)
    in_order = F.col("a") < F.col("b")  # names sort otherwise than their words
    pick = lambda x, y, name: F.when(in_order | (F.length("a") != F.length("b")), F.col(x)).otherwise(F.col(y)).alias(name)
    spelt = spelt.select(pick("a", "b", "a"), pick("a_n", "b_n", "a_n"), pick("b", "a", "b"), pick("b_n", "a_n", "b_n"))
    return short.unionByName(spelt).distinct()


def _roots(forms: DataFrame, times: int, largest: int) -> DataFrame:
    """Rows (word, root) of the words that have a form.

    A form's count is ``times`` its word's at least, so chains have at most
    log(largest) steps and doubling them a few times reaches every end.
    """
    steps = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(max(2.0, math.log(max(2, largest), times)))))):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = written(steps.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return steps


def variants(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = FORM_TIMES, most: int = LONG_LIST
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of all words of at least ``min_chars`` characters and ``min_count`` occurrences."""
    if min_chars < LEAST_CHARS or times < 2:
        raise ValueError(f"words need {LEAST_CHARS} characters at least, and forms twice the word's count")
    found = written(words(docs, text=text, key=key, min_chars=min_chars, min_count=min_count), "words")
    pairs = written(near_pairs(found, most=most), "near")
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs.select(F.explode(sides).alias("_s")).select("_s.*").groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_b"))
    enough = -F.col("_b.less") >= times * F.col("n")
    near = written(near.select("word", "n_near", F.when(enough, F.col("_b.near")).alias("form"), F.when(enough, -F.col("_b.less")).alias("form_n")), "forms")
    largest = near.agg(F.max("form_n")).first()[0] or 1
    roots = _roots(near.where("form is not null"), times, largest)
    return (
        found.join(near, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
