"""Byte-pair vocabularies read from public tokenizer files.

A vocabulary file is named by a path parameter and read on the driver and in
the workers (it is installed with the tokenizer package on every machine, or
shipped by the caller); its size is fixed, it does not grow with the data.
"""
from __future__ import annotations

import functools
import json
from dataclasses import dataclass

import numpy as np
import regex


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocab:
    """Merge table and splitting rules of one file.

    first / last: symbol id of a byte inside a word, and at its end (where the
    file marks word ends). pairs: sorted keys left * size + right; ranks and
    made: the rank and the resulting symbol of each pair.
    """

    path: str
    size: int
    tokens: dict[int, str]
    ids: dict[str, int]
    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    pattern: regex.Pattern
    specials: dict[str, int]
    special_split: regex.Pattern | None
    lowercase: bool
    drop_unmatched: bool
    bytes_of: dict[str, int]

    def word_bytes(self, token: str) -> bytes | None:
        """The bytes a token string stands for, None where it is no byte string."""
        suffix_free = token[:-4] if self.drop_unmatched and token.endswith("</w>") else token
        try:
            return bytes(self.bytes_of[c] for c in suffix_free)
        except KeyError:
            return None


#: The split that byte-level files imply when they give no pattern of their own (a fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=8)
def load(path: str) -> Vocab:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, chars = spec["model"], byte_chars()
    ids = model["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*ids.values(), *specials.values()]) + 1
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    keys = np.array([ids[a] * size + ids[b] for a, b in merges], dtype=np.int64)
    made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    own_split = next((p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"), None)
    lowercase = any(n["type"] == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
    first = np.array([ids[chars[b]] for b in range(256)], dtype=np.int64)
    last = np.array([ids[chars[b] + suffix] for b in range(256)], dtype=np.int64)
    return Vocab(
        path=path, size=size, tokens={i: t for t, i in (ids | specials).items()}, ids=ids, first=first, last=last,
        pairs=keys[order], ranks=order.astype(np.int64), made=made[order],
        pattern=regex.compile(own_split or BYTE_LEVEL_PATTERN), specials=specials,
        special_split=regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None,
        lowercase=lowercase, drop_unmatched=bool(suffix), bytes_of={c: b for b, c in chars.items()},
    )
