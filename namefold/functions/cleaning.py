"""Name cleaning as column expressions.

Every step takes and returns a string column, so the whole chain is one projection on the JVM. The
patterns use Unicode classes (``U``) and Unicode case folding; ``WS`` adds the four control characters
that also count as white space in names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from namefold.config import HONORIFICS, JUNK_WORDS

WS = r"[\s\x1c-\x1f]"

# Month stems and date shapes, tried in this order at every position of the text.
_MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_SEP = r"[/\-.]"
DATE_SHAPES = (
    rf"\d{{1,2}}{_SEP}\d{{1,2}}{_SEP}\d{{2,4}}",
    rf"\d{{4}}{_SEP}\d{{1,2}}{_SEP}\d{{1,2}}",
    rf"\d{{1,2}}{WS}*{_MONTH}(?:{WS}+\d{{2,4}})?",
    rf"{_MONTH}{WS}+\d{{1,2}},?{WS}*\d{{0,4}}",
    r"\d{8}",
)


def _whole_words(alternatives) -> str:
    return rf"(?iU)\b(?:{'|'.join(alternatives)})\b\.?{WS}*"


_DATES = f"(?iU)(?:{'|'.join(DATE_SHAPES)})"


def _spaced(word: str) -> str:
    """A literal word; a blank in it stands for any white space, or none."""
    return f"{WS}*".join(re.escape(part) for part in word.split())


def null_safe(c: Column) -> Column:
    """Null and non-string input become text; null and blank text become the empty string."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike(rf"(?U)\A{WS}*\z"), "").otherwise(text)


def drop_dates(c: Column) -> Column:
    """Remove dates in any of the known shapes, also inside words."""
    return F.regexp_replace(c, _DATES, "")


def drop_prefixes(c: Column, honorifics: tuple[str, ...] = HONORIFICS) -> Column:
    """Remove honorifics that stand as whole words, wherever they are."""
    return F.regexp_replace(c, _whole_words(map(_spaced, honorifics)), "") if honorifics else c


def drop_junk_words(c: Column, junk_words: tuple[str, ...] = JUNK_WORDS) -> Column:
    """Remove payment-channel and company-form words that stand as whole words."""
    return F.regexp_replace(c, _whole_words(map(_spaced, junk_words)), "") if junk_words else c


def drop_brackets(c: Column) -> Column:
    """Remove bracket characters and keep what they enclose."""
    return F.translate(c, "(){}[]", "")


def drop_digits(c: Column) -> Column:
    """Remove decimal digits of any script."""
    return F.regexp_replace(c, r"(?U)\d+", "")


def trim_edge_noise(c: Column) -> Column:
    """Strip everything but ASCII letters from both ends."""
    return F.regexp_replace(F.regexp_replace(c, r"\A[^a-zA-Z]+", ""), r"[^a-zA-Z]+\z", "")


def standardize(c: Column) -> Column:
    """Lower-case, reduce runs of white space to one space, strip."""
    collapsed = F.regexp_replace(F.lower(c), rf"(?U){WS}{{2,}}", " ")
    return F.regexp_replace(collapsed, rf"(?U)\A{WS}+|{WS}+\z", "")


def clean_name(
    c: Column, honorifics: tuple[str, ...] = HONORIFICS, junk_words: tuple[str, ...] = JUNK_WORDS
) -> Column:
    """The full cleaning chain, each step applied once. A later step sees what the earlier ones left."""
    c = drop_prefixes(drop_dates(null_safe(c)), honorifics)
    c = drop_digits(drop_brackets(drop_junk_words(c, junk_words)))
    return standardize(trim_edge_noise(c))
