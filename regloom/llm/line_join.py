"""Operator 10 [native]: line dedup by an exact set-similarity join.

A line's set holds its distinct lower-case words. A line is removed when an
earlier line of the corpus (by key, then line number) is the same line, or has
a set with 100 * intersection >= percent * union.

1. Rarity: word counts over all lines, in 2**18 hash cells, order every line's
   words from rare to common (ties by hash). Only this table of fixed size
   reaches the driver and goes back out as a literal.
2. Different lines: one row for each, with its first place, its size, the
   hashes of its rarest words, and 128 parities of its words. Texts stay where
   they are; these rows alone are shuffled, and stored bucketed by line.
3. Groups of copies: lines that agree in their three smallest or three largest
   word hashes (long ones also in the next threes) are compared with the
   earliest such line, and those that match it are settled. In a group of n near copies that leaves few lines to pair
   with the others.
4. Prefix join: of two similar sets the larger has one of the words among its
   (1 - t) * size + 1 rarest that the smaller has among its
   (1 - t) / (1 + t) * size + 1 rarest. Lines meet on those words; the length
   filter, the positional filter (what can still be shared after this word)
   and the parities (a lower bound of the words not shared) discard pairs
   inside the join. The words are met in ``PASSES`` jobs, one after the other,
   so that only one job's rows are on disk at a time. A settled line is needed only as the earlier one of a pair.
5. Verification fetches the texts of the lines that are left in a pair, each
   once, and counts the words that they share.

Lines are told apart by their MD5. Null texts are empty; a line without
a word is never removed. Sets so small that only an equal set is similar (up to
three words at 80 percent) need no prefix join: equal sets form one group of
copies, which step 3 settles. ``min_words`` above 1 leaves lines of fewer
different words alone. Rows that share key and text are one document: the same
line in the same place of both is not removed. Rows that share a key, or have
none, but differ in text are different documents, ordered by line number and
then by the text's hash. Extra columns are passed through by ``drop_lines`` and
left aside otherwise. An empty table gives no rows.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from regloom.session import written, written_by

PERCENT, MIN_WORDS = 80, 3
#: Cells of the rarity table (a power of two), and 64-bit words of a filter's bit table at most.
CELLS, FILTER_WORDS = 1 << 18, 1 << 14
#: Sizes and places are kept up to these numbers in the prefix join; sets that reach them pass its filters.
MOST_WORDS, MOST_PLACE = (1 << 16) - 1, (1 << 15) - 1
#: Jobs that the prefix words are met in.
PASSES = 3
_BLANK = "\t\x0b\x0c\r"


def normal(text: Column) -> Column:
    """Lower case, white space inside lines as spaces."""
    odd = F.lit(False)
    for c in _BLANK:
        odd = odd | F.contains(text, F.lit(c))
    return F.lower(F.when(odd, F.translate(text, _BLANK, " " * len(_BLANK))).otherwise(text))


def _hashes(body: Column) -> Column:
    """Distinct hashes of a normal line's words."""
    return F.array_remove(F.array_distinct(F.transform(F.split(body, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _row_id(text: str) -> Column:
    """With the key, the identity of a document: rows that share a key but not a text are different documents."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(did, rid, lno, num, lid, body) of every line in normal form: its MD5 is its identity, a 64-bit hash its number in pairs."""
    bodies = F.split(normal(F.coalesce(text, F.lit(""))), "\n")
    named = docs.select(F.col(key).alias("did"), _row_id(text).alias("rid"), text)  # hashed once, not for every line
    rows = named.select("did", "rid", F.posexplode(bodies).alias("lno", "body"))
    return rows.select("did", "rid", "lno", F.xxhash64("body").alias("num"), F.unhex(F.md5("body")).alias("lid"), "body")


def _dense(numbers: DataFrame, size: int) -> DataFrame:
    """One row, one array: number ``x`` of each place ``at`` below ``size`` (a fixed one), 0 where there is none."""
    every = numbers.sparkSession.range(size, numPartitions=1).withColumnRenamed("id", "at").join(numbers, "at", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("x", F.lit(0)).alias("x")))).alias("all")).select("all.x")


def rarity(docs: DataFrame, *, text: str = "text") -> Column:
    """Array literal: for each hash cell 4 * log2(1 + occurrences of its words), over all texts."""
    cell = F.xxhash64("w").bitwiseAND(F.lit(CELLS - 1)).cast("int")
    words = docs.select(F.explode(F.split(F.replace(normal(F.col(text)), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(cell.alias("cell")).agg(F.floor(4 * F.log2(F.count(F.lit(1)) + 1)).cast("int").alias("level"))
    table = [0] * CELLS
    packed = counts.groupBy(F.shiftright("cell", 8).alias("run")).agg(F.collect_list(F.shiftleft("cell", 8) + F.col("level")).alias("levels"))
    for r in packed.collect():  # CELLS numbers at most, in CELLS / 256 rows
        for x in r["levels"]:
            table[x >> 8] = x & 255
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def _parity(hashes: str, half: int) -> Column:
    """One half of 128 bits: for each value of seven bits of the hash whether an odd number of words has it.

    The bits in which two sets' numbers differ are, in both halves together, no
    more than the words that only one of them has.
    """
    bits = [0] * (64 * half) + [1 << i for i in range(63)] + [-(1 << 63)] + [0] * (64 - 64 * half)
    table = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<long>")
    return F.reduce(hashes, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(F.get(table, h.bitwiseAND(F.lit(127)).cast("int"))))


def _differ(x: str, y: str) -> Column:
    """Words that only one of two sets has, at least."""
    return F.bit_count(F.col(f"{x}odd0").bitwiseXOR(F.col(f"{y}odd0"))) + F.bit_count(F.col(f"{x}odd1").bitwiseXOR(F.col(f"{y}odd1")))


def different_lines(docs: DataFrame, *, text: str = "text", key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per different line, as a table bucketed by ``lid``: (lid, num, first, n, keys, odd0, odd1, prefix).

    keys are numbers that very similar sets share with high probability; a set of
    up to three words has one key, which only equal sets share. ``prefix`` holds
    32-bit hashes of the rarest words, enough to share one with any similar set.
    """
    spark = docs.sparkSession
    table = rarity(docs, text=text)
    place = F.struct("did", "lno", "rid").alias("first")
    sets = _lines(docs, text, key).where(F.trim("body") != "").select("lid", "num", place, F.sort_array(_hashes(F.col("body"))).alias("h"))
    if min_words > 1:  # a condition on the words is pushed down, where they are hashed once more
        sets = sets.where(F.size("h") >= min_words)
    n = F.size("h")
    # Rarity in the high bits, then the hash; only the order and 32 bits of the hash are kept.
    rank = lambda h: F.shiftleft(F.get(table, h.bitwiseAND(F.lit(CELLS - 1)).cast("int")).cast("long"), 48) + F.shiftrightunsigned(h, 16)
    # ceil(percent * n / 100) words must be shared with a set of n at least: prefix length n - that + 1.
    length = (n - F.ceil(n * F.lit(percent) / 100) + 1).cast("int")
    rarest = F.transform(F.slice(F.sort_array(F.transform("h", rank)), F.lit(1), length), lambda w: F.pmod(w, F.lit(1 << 32)) - F.lit(1 << 31))
    three = lambda i, start: F.xxhash64(F.lit(i), F.slice("h", start, 3))
    large = F.when(n < 18, F.array(three(0, 1), three(1, -3))).otherwise(F.array(three(0, 1), three(1, -3), *[three(i, at) for i, at in ((3, 4), (4, 7), (5, -6), (6, -9))]))
    keys = F.when(n <= 3, F.array(F.xxhash64(F.lit(2), F.col("h")))).otherwise(large)
    # A set of up to three words with 100 * n < percent * (n + 1) is similar to equal sets only.
    alone = (n <= 3) & (n * 100 < F.lit(percent) * (n + 1))
    prefix = F.when(alone, F.array().cast("array<int>")).otherwise(rarest.cast("array<int>"))
    rows = sets.select("lid", "num", "first", n.alias("n"), keys.alias("keys"), _parity("h", 0).alias("odd0"), _parity("h", 1).alias("odd1"), prefix.alias("prefix"))
    same = [F.first(c).alias(c) for c in ("num", "n", "keys", "odd0", "odd1", "prefix")]
    return written_by(rows.groupBy("lid").agg(F.min("first").alias("first"), *same), "lines", "lid")


def _among(ids: DataFrame, column: str) -> Column:
    """Condition on a number column that holds for all of ``ids`` and, while they are few, for little else.

    A bit table of fixed size; what passes it by chance is left to the join behind it.
    """
    at = F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))
    marks = ids.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("x"))
    mark = F.get(_dense(marks, FILTER_WORDS).scalar(), F.shiftright(at, 6).cast("int"))
    return F.call_function("shiftrightunsigned", mark, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _verified(pairs: DataFrame, docs: DataFrame, text: str, key: str, percent: int) -> DataFrame:
    """(lid) of the later line of every pair (x, y) of numbers that is similar, by the words of both."""
    wanted = written(pairs.select(F.explode(F.array("x", "y")).alias("num")).distinct(), "wanted")
    found = _lines(docs, text, key).where(_among(wanted, "num")).join(wanted, "num", "left_semi")
    sets = written(found.groupBy("num", "lid").agg(F.min(F.struct("did", "lno", "rid")).alias("first"), F.first("body").alias("body")), "texts")
    side = lambda s: sets.select(F.col("num").alias(s), F.col("lid").alias(f"l{s}"), F.col("first").alias(f"f{s}"), F.col("body").alias(f"b{s}"))
    words = lambda s: F.array_remove(F.array_distinct(F.split(f"b{s}", " ")), "").alias(f"w{s}")
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("lx", "ly", "fx", "fy", words("x"), words("y")).withColumn("shared", F.size(F.array_intersect("wx", "wy")))
    near = both.where(100 * F.col("shared") >= percent * (F.size("wx") + F.size("wy") - F.col("shared")))
    return near.select(F.when(F.col("fx") < F.col("fy"), F.col("ly")).otherwise(F.col("lx")).alias("lid")).distinct()


def _close(x: str, y: str, percent: int) -> Column:
    """What sizes and parities leave: similar sets differ in (nx + ny) * (100 - percent) / (100 + percent) words at most."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (_differ(x, y) * (100 + percent) <= (nx + ny) * (100 - percent))


def _families(lines: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of the earliest line of each key and the others that may match it."""
    keys = lines.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("key")
    shared = written(keys, "keys")
    members = lines.select(F.explode("keys").alias("key"), "num", "n", "odd0", "odd1", "first").where(_among(shared, "key")).join(shared, "key", "left_semi")
    head = F.min(F.struct("first", "num", "n", "odd0", "odd1"))
    heads = written(members.groupBy("key").agg(head.alias("h")).select("key", "h.*"), "heads")
    others = members.select("key", F.struct("num", "n", "odd0", "odd1").alias("o"))
    met = heads.select("key", F.struct("num", "n", "odd0", "odd1").alias("h")).join(others, "key")
    named = met.select(*[F.col(f"{c}.{f}").alias(s + t) for c, s in (("h", "x"), ("o", "y")) for f, t in (("num", ""), ("n", "n"), ("odd0", "odd0"), ("odd1", "odd1"))])
    return named.where((F.col("x") != F.col("y")) & _close("x", "y", percent)).select("x", "y").distinct()


def _candidates(lines: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) that meet on a prefix word and pass the filters."""
    known = lines.join(settled.withColumn("settled", F.lit(1)), "lid", "left")
    entries = known.select(
        "num", F.posexplode("prefix").alias("at", "word"), F.least("n", F.lit(MOST_WORDS)).cast("long").alias("n"), "odd0", "odd1", _place(lines).alias("place"), F.coalesce("settled", F.lit(0)).cast("long").alias("settled")
    )
    # One number for place in the corpus, size, place in the line and state keeps the shuffled rows small.
    at = F.least("at", F.lit(MOST_PLACE)).cast("long")
    packed = entries.select("word", "num", "odd0", "odd1", (F.shiftleft("place", 32) + F.shiftleft("n", 16) + F.shiftleft(at, 1) + F.col("settled")).alias("m"))
    part = lambda s, by, bits: F.shiftrightunsigned(f"{s}m", by).bitwiseAND(F.lit((1 << bits) - 1))
    side = lambda s: packed.select("word", F.col("num").alias(s), *[F.col(c).alias(f"{s}{c}") for c in ("m", "odd0", "odd1")])
    xn, yn, xat, yat = part("x", 16, 16), part("y", 16, 16), part("x", 1, 15), part("y", 1, 15)
    full = (xn >= MOST_WORDS) | (yn >= MOST_WORDS) | (xat >= MOST_PLACE) | (yat >= MOST_PLACE)
    # x is the smaller set (ties by number): of its words the first size - ceil(2 t / (1 + t) * size) + 1 suffice.
    smaller = (xn < yn) | ((xn == yn) & (F.col("x") < F.col("y")))
    indexed = (xn - xat) * (100 + percent) >= xn * (2 * percent)
    enough = F.least(xn - xat, yn - yat) * (100 + percent) >= F.lit(percent) * (xn + yn)  # this word and what follows
    apart = _differ("x", "y") * (100 + percent) <= (xn + yn) * (100 - percent)
    sized = xn * 100 >= yn * percent
    xs, ys = part("x", 0, 1), part("y", 0, 1)
    open_ = (xs + ys == 0) | ((xs + ys == 1) & F.when(xs == 1, part("x", 32, 31) <= part("y", 32, 31)).otherwise(part("y", 32, 31) <= part("x", 32, 31)))
    # Tested after the shuffle (a place is never negative, but that keeps the test in the join): both sides are the same shuffled rows.
    in_index = indexed | full | (yat < 0)
    passes = sized & smaller & (full | apart) & in_index & (full | enough) & open_  # what discards most comes first

    def met(k: int) -> DataFrame:
        x, y = (side(s).where(F.pmod("word", F.lit(PASSES)) == k) for s in "xy")
        return written(x.join(y, "word").where(passes).select("x", "y").distinct(), "met")

    return _sharing(reduce(DataFrame.unionByName, map(met, range(PASSES))).distinct(), lines, percent)


def _place(lines: DataFrame) -> Column:
    """A number of 31 bits that rises with a line's key, where that is a number (0 elsewhere): an earlier line never has the larger one."""
    did = F.col("first.did")
    if not isinstance(lines.schema["first"].dataType["did"].dataType, NumericType):
        return F.lit(0).cast("long")
    low, high = lines.agg(F.min(did).cast("double"), F.max(did).cast("double")).first()
    if low is None or high <= low:
        return F.lit(0).cast("long")
    share = F.floor((did.cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(float((1 << 31) - 2))).cast("long")
    return F.when(did.isNull(), F.lit(0)).otherwise(share + 1).cast("long")


def _sharing(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes share enough.

    Of the set whose prefix ends at the rarer word, the prefix's words that the
    other has are in the other's prefix. So the sets share no more than their
    prefixes do (equal hashes only add to it) and what lies behind the prefix.
    """
    side = lambda s: lines.select(F.col("num").alias(s), F.col("n").alias(f"{s}n"), F.col("prefix").alias(f"{s}p"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    behind = F.greatest(F.col("xn") - F.size("xp"), F.col("yn") - F.size("yp"))
    return both.where((F.size(F.array_intersect("xp", "yp")) + behind) * (100 + percent) >= F.lit(percent) * (F.col("xn") + F.col("yn"))).select("x", "y")


def repeated_lines(lines: DataFrame, docs: DataFrame, *, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(lid) of every different line that is similar to an earlier one."""
    settled = written(_verified(written(_families(lines, percent), "families"), docs, text, key, percent), "settled")
    found = written(_candidates(lines, settled, percent), "candidates")
    return settled.unionByName(_verified(found, docs, text, key, percent)).distinct()


def line_flags(docs: DataFrame, *, text: str = "text", key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(did, rid, removed array<boolean>): for each document whether each of its lines goes; one row per different key and text."""
    lines = different_lines(docs, text=text, key=key, percent=percent, min_words=min_words)
    near = repeated_lines(lines, docs, text=text, key=key, percent=percent).withColumn("near", F.lit(True))
    judged = lines.select("lid", "first").join(near, "lid", "left")
    places = _lines(docs, text, key).select("did", "rid", "lno", "lid")
    goes = F.col("first").isNotNull() & (F.col("near").isNotNull() | ~F.col("first").eqNullSafe(F.struct("did", "lno", "rid")))
    flagged = places.join(judged, "lid", "left").select("did", "rid", "lno", goes.alias("goes"))
    return flagged.groupBy("did", "rid").agg(F.sort_array(F.collect_set(F.struct("lno", "goes"))).alias("all")).select("did", "rid", F.col("all.goes").alias("removed"))


def report(docs: DataFrame, *, text: str = "text", key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: (key, n_lines, n_removed, removed_lines); lines count from 0."""
    flags = line_flags(docs, text=text, key=key, percent=percent, min_words=min_words)
    places = F.filter(F.transform("removed", lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    return flags.select(F.col("did").alias(key), F.size("removed").cast("long").alias("n_lines"), places.alias("removed_lines")).select(
        key, "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines"
    )


def drop_lines(docs: DataFrame, *, text: str = "text", key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated lines taken out of their text; those left without any word go."""
    flags = line_flags(docs, text=text, key=key, percent=percent, min_words=min_words).select(F.col("did").alias("_did"), F.col("rid").alias("_rid"), F.col("removed").alias("_removed"))
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: ~F.get(F.col("_removed"), i))
    joined = docs.join(flags, docs[key].eqNullSafe(flags["_did"]) & (_row_id(text) == F.col("_rid")))
    cleaned = F.when(F.exists("_removed", lambda x: x), F.array_join(kept, "\n")).otherwise(F.col(text))
    gone = F.exists("_removed", lambda x: x) & ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    return joined.withColumn(text, cleaned).where(~F.coalesce(gone, F.lit(False))).select(*docs.columns)
