"""Text columns: Unicode-aware stripping, literal word tests and number formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space at the ends: what Java's Unicode class has, and four separators that it lacks.
_EDGE = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"

# The characters that phrases are made of.
CJK = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}"

# Patterns of the scores.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
URL = r"(?i)https?://[^\s()<>\"']+|(?:www\.)[^\s()<>\"']+"
PHONE = r"1[3-9]\d{9}"
ID_CARD = r"[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx]"
LONG_NUMBER = r"(?U)\b[1-9][0-9]{4,10}\b"
PUNCTUATION_ONLY = r"(?U)^[^\w\s一-鿿]+$"
NOT_X_BUT_Y = r"不是[^。]*而是"
FIRST_THEN = r"先[^。]*再[^。]*"
ANALYSIS_KEY = r"主要是|关键是|本质上|说白了"
I_FEEL = r"我感觉|我个人|我认为|我觉得"
SENTENCE_END = r"[。！？\n]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE, "")


def blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def quoted(word: str) -> str:
    """A pattern of the literal word, whatever its case."""
    return r"(?iu)\Q" + word.replace(r"\E", r"\E\\E\Q") + r"\E"


def hits(text: Column, words: Sequence[str], ignore_case: bool = False) -> Column:
    """How many of the words the text contains; a word listed twice counts twice."""
    if not words:
        return F.lit(0)
    if not ignore_case:
        return _sum_of([F.when(text.contains(w), 1).otherwise(0) for w in words])
    return _sum_of([F.when(text.rlike(quoted(w)), 1).otherwise(0) for w in words])


def _sum_of(columns: list[Column]) -> Column:
    """A balanced sum: long chains would make the expression tree too deep."""
    while len(columns) > 1:
        columns = [columns[i] + columns[i + 1] if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0]


def any_of(text: Column, words: Sequence[str]) -> Column:
    """Whether the text contains any of the words, case-sensitively: one pass with one pattern."""
    if not words:
        return F.lit(False)
    return text.rlike("|".join(r"\Q" + w.replace(r"\E", r"\E\\E\Q") + r"\E" for w in words))


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping occurrences; of the empty word one more than characters."""
    if not word:
        return F.length(text) + 1
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word)).cast("long")


def total_occurrences(text: Column, words: Sequence[str]) -> Column:
    return _sum_of([occurrences(text, w) for w in words]) if words else F.lit(0).cast("long")


def bigrams(text: Column) -> Column:
    """The distinct character pairs of a text; none below two characters.

    Characters are split once: taking substrings of a long text would be quadratic.
    """
    chars = F.split(text, "")
    n = F.length(text) - 1
    pairs = F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))
    return F.when(n >= 1, F.array_distinct(pairs)).otherwise(F.expr("cast(array() as array<string>)"))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def number_text(c: Column) -> Column:
    """A score as text, always with a decimal point."""
    return c.cast("double").cast("string")


def plain(pattern: str) -> str:
    """The pattern for RE2, which has no Unicode flag for word boundaries."""
    return re.sub(r"\(\?U\)", "", pattern)
