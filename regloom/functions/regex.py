"""Regular-expression helpers that keep Python ``re`` semantics on Java regex.

Python's ``\\s``, ``\\b``, ``\\d`` and case folding are Unicode-aware; Java's are
ASCII unless ``(?U)`` is set. Python's ``.`` stops only at ``\\n``; Java's also
stops at ``\\r``, U+0085 and U+2028/9 unless ``(?d)`` (UNIX_LINES) is set. Every
pattern built here therefore carries ``(?Ud)`` plus the caller's flags, and all
calls stay JVM-side (``rlike``, ``regexp_extract``, ``regexp_extract_all``,
``regexp_replace``), inside whole-stage codegen.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() also accepts U+001C..U+001F, Java's \p{White_Space} does not.
PY_SPACE = r"[\s\x1c-\x1f]"


def pattern(p: str, *, ignore_case: bool = False, dotall: bool = False) -> str:
    """Prefix the inline flags that give Python-like behaviour."""
    flags = "U" + "d" + ("i" if ignore_case else "") + ("s" if dotall else "")
    return f"(?{flags}){p}"


def find_all(text: Column, p: str, group: int = 0, *, ignore_case: bool = False, dotall: bool = False) -> Column:
    """All non-overlapping matches, left to right (``re.findall``)."""
    return F.regexp_extract_all(text, F.lit(pattern(p, ignore_case=ignore_case, dotall=dotall)), F.lit(group))


def sorted_distinct(text: Column, p: str, group: int = 0, *, ignore_case: bool = False) -> Column:
    """``sorted(set(re.findall(p, text)))``: byte order of UTF-8 equals code-point order."""
    return F.array_sort(F.array_distinct(find_all(text, p, group, ignore_case=ignore_case)))


def first_group(text: Column, p: str, group: int = 1, *, ignore_case: bool = False, dotall: bool = False) -> Column:
    """Group of the first match, or null when there is no match.

    ``regexp_extract`` returns '' both for "no match" and for an empty group,
    so the match itself is tested separately.
    """
    pat = pattern(p, ignore_case=ignore_case, dotall=dotall)
    return F.when(text.rlike(pat), F.regexp_extract(text, pat, group))


def search(text: Column, p: str, *, ignore_case: bool = False, dotall: bool = False) -> Column:
    """``bool(re.search(p, text))``; null text gives false."""
    return F.coalesce(text.rlike(pattern(p, ignore_case=ignore_case, dotall=dotall)), F.lit(False))


# Python's whitespace set, built by rule: every code point for which
# str.isspace() is true (29 characters).
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def py_strip(c: Column) -> Column:
    """``str.strip()``: a character-set trim (no regex) with Python's whitespace
    set; plain ``trim`` would strip spaces only."""
    return F.trim(c, F.lit(PY_WHITESPACE))


def py_lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(PY_WHITESPACE))
