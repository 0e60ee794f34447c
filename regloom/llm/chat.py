"""Operator 7 [native]: chat formatting with prefix-target expansion.

A conversation's turns, in order, are rendered as one transcript:

    ### user: text </turn>
    ### assistant: text </turn>

A backslash is put before every backslash, ``### `` and ``</turn>`` that a
text holds, so the template's own marks are the only bare ones and dropping
one backslash of each pair gives the text back. Role names are URL-encoded
(the usual names stay as they are).

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is under the loss mask. The formatted rows name a
context by its length, since contexts are prefixes of the transcript; ``expand``
writes every example's context and target out (the contexts' size grows with
the square of a conversation's length; ``contexts=False`` leaves them to the
reader), and ``digests`` reads those examples back.

Null texts and roles are empty strings; turns are ordered by turn (null
first), then role and text, so repeated rows stand side by side. A null
conversation id is an id of its own. Other columns are left aside. An empty
table gives no rows. A conversation is one training text and one digest, so
one task holds it whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, ANSWERER = "### ", "</turn>", "assistant"
#: Ends a turn; inside texts the mark has a backslash before it.
_END = rf"(?<!\\){CLOSE}\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|### |</turn>)", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: (conv, transcript, spans); spans lists where each assistant reply lies in the transcript.

    A span has ``context_chars``, the characters before the reply (its own
    role mark included), and ``target_chars``; both count code points.
    """
    clean = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_role"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    marked = clean.select(
        "_conv", "_turn", "_role", "_text", F.concat(F.lit(OPEN), F.url_encode("_role"), F.lit(": ")).alias("_head"), escaped(F.col("_text")).alias("_body")
    ).withColumn("_size", F.length("_head") + F.length("_body") + F.lit(len(" " + CLOSE + "\n")))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_text")
    placed = marked.select(
        "_conv", F.row_number().over(order).alias("at"), "_role", F.concat("_head", "_body", F.lit(" " + CLOSE + "\n")).alias("part"),
        (F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size") + F.length("_head")).alias("before"), F.length("_body").alias("size"),
    )
    whole = placed.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("_role") == ANSWERER, F.struct("at", "before", "size")))).alias("replies"),
    )
    return whole.select(
        F.col("_conv").alias(conv),
        F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("transcript"),
        F.transform("replies", lambda x: F.struct(x["before"].alias("context_chars"), x["size"].cast("long").alias("target_chars"))).alias("spans"),
    )


def expand(formatted: DataFrame, *, conv: str = "conv_id", contexts: bool = True) -> DataFrame:
    """One example per assistant turn: (conv, example, context_chars, target[, context]).

    ``target`` is the reply as it stands in the transcript (still escaped) and
    under the loss mask; the context is everything before it, the transcript's
    first ``context_chars`` characters, and not under the mask.
    """
    # One example at a time is cut out, so a long conversation's contexts are never in memory together.
    rows = formatted.select(conv, "transcript", F.posexplode("spans").alias("example", "x"))
    cut = lambda start, size: F.substring(F.col("transcript"), start, size.cast("int"))
    target = cut((F.col("x.context_chars") + 1).cast("int"), F.col("x.target_chars")).alias("target")
    more = [cut(F.lit(1), F.col("x.context_chars")).alias("context")] if contexts else []
    return rows.select(conv, F.col("example").cast("long").alias("example"), "x.context_chars", target, *more)


def read_turns(formatted: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<role, text>>) read back from transcripts."""

    def turn(part: Column) -> Column:
        colon = F.locate(": ", part)
        role = F.url_decode(F.substring(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1))
        return F.struct(role.alias("role"), unescaped(F.substring(part, colon + 2, F.length(part) - colon - 2)).alias("text"))

    parts = F.split("transcript", _END)
    return formatted.select(F.col(conv), F.transform(F.slice(parts, 1, F.size(parts) - 1), turn).alias("turns"))


def digests(formatted: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples, context_turns, example_chars), all read from the formatted output.

    The last three and the loss come from the expanded examples: context_turns
    counts the whole turns in all their contexts, example_chars all characters
    of their contexts and targets.
    """
    turns = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    told = read_turns(formatted, conv=conv).select(
        F.col(conv).alias("_conv"), F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256")
    )
    sizes = formatted.select(F.col(conv).alias("_conv"), F.length("transcript").cast("long").alias("formatted_chars"))
    read = expand(formatted, conv=conv).select(
        F.col(conv).alias("_conv"), "example", unescaped(F.col("target")).alias("target"), F.regexp_count("context", F.lit(_END)).alias("turns"),
        (F.length("context") + F.length("target")).alias("chars"),
    )
    loss = read.groupBy("_conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda x: x["target"]), "").alias("loss"),
        F.count(F.lit(1)).alias("n"), F.sum("turns").alias("turns"), F.sum("chars").alias("chars"),
    )
    t, s, x = told.alias("t"), sizes.alias("s"), loss.alias("x")
    joined = t.join(s, F.col("t._conv").eqNullSafe(F.col("s._conv"))).join(x, F.col("t._conv").eqNullSafe(F.col("x._conv")), "left")
    or_none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        F.col("t._conv").alias(conv), "n_turns", "turns_sha256", F.coalesce(F.length("loss"), F.lit(0)).cast("long").alias("loss_chars"),
        F.sha2(F.coalesce("loss", F.lit("")), 256).alias("loss_sha256"), "formatted_chars", or_none("n").alias("n_examples"),
        or_none("turns").alias("context_turns"), or_none("chars").alias("example_chars"),
    )
