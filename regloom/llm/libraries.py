"""Public tokenizer libraries inside tasks: one instance per worker and file, and cutting of long texts.

A library's working memory is many times its text, so texts are handed over
about a megabyte at a time, and a longer text in pieces that encode alone as
they do in the whole text.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import regex

from regloom.llm.vocab import load

#: Code points after which a text is cut at the next place where a new pre-token always starts.
PIECE_CHARS = 1 << 18
_CUT = regex.compile(r"(?<=\S)(?= \S)")


@functools.lru_cache(maxsize=4)
def byte_tokenizer(path: str):
    """The byte-level vocabulary of a tokenizers file with its special tokens, merged by tiktoken's core.

    Such a file numbers its tokens in merge order, so that a token's id is its
    rank, and splits by the pattern of the rank files. The ids are those of
    the tokenizers library (tests hold both against each other), which takes
    four times as long.
    """
    import tiktoken

    vocab = load(path)
    if vocab.drop_unmatched or vocab.lowercase:
        raise ValueError("not a byte-level vocabulary")
    ranks = {vocab.word_bytes(t): i for i, t in vocab.tokens.items() if t not in vocab.specials}
    return tiktoken.Encoding(path, pat_str=vocab.pattern.pattern, mergeable_ranks=ranks, special_tokens=dict(vocab.specials))


@functools.lru_cache(maxsize=4)
def piece_tokenizer(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=4)
def pieces_start_words(path: str) -> bool:
    """Whether no piece holds a space after another character: then no merge crosses the start of a word."""
    sp = piece_tokenizer(path)
    return not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))


def cut(text: str, most: int = PIECE_CHARS) -> list[str]:
    """Pieces of a text that encode alone as in the whole: cut before a single space between two words."""
    if len(text) <= most:
        return [text]
    out, lo = [], 0
    while len(text) - lo > most and (m := _CUT.search(text, lo + most)):
        out.append(text[lo : m.start()])
        lo = m.start()
    return [*out, text[lo:]]


def blocks(texts: list[str], most: int = PIECE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of together about ``most`` code points (at least one text)."""
    lo = n = 0
    for hi, t in enumerate(texts, 1):
        n += len(t)
        if n >= most:
            yield texts[lo:hi]
            lo, n = hi, 0
    if lo < len(texts):
        yield texts[lo:]


def encode_bytes(path: str, texts: list[str], plain_specials: bool = False) -> Iterator[np.ndarray]:
    """Ids of each text as the tokenizers library gives them, without added special tokens; ``plain_specials``: their strings are ordinary text."""
    t, allowed = byte_tokenizer(path), set() if plain_specials else "all"
    for x in texts:
        parts = [t.encode_to_numpy(p, allowed_special=allowed, disallowed_special=()) for p in cut(x)]
        yield parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_pieces(path: str, texts: list[str]) -> Iterator[list[int]]:
    """Ids of each text by the sentencepiece library, which puts a space before the text (and before each cut piece in place of its own)."""
    sp = piece_tokenizer(path)
    parts = [cut(x) if pieces_start_words(path) else [x] for x in texts]
    found = iter(sp.encode([p[1:] if k else p for ps in parts for k, p in enumerate(ps)], num_threads=1))
    for ps in parts:
        yield next(found) if len(ps) == 1 else [i for _ in ps for i in next(found)]
