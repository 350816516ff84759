"""Tokens and character n-grams as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from namefold.functions.cleaning import WS


def tokens(name: Column) -> Column:
    """White-space separated tokens, without empty ones."""
    return F.filter(F.split(name, f"(?U){WS}+"), lambda t: t != "")


def token_key(name: Column) -> Column:
    """The tokens in sorted order, joined by one space.

    Names with equal keys have equal n-gram counts and equal fuzzy scores against any other name.
    """
    return F.array_join(F.array_sort(tokens(name)), " ")


def char_wb_grams(words: str, lo: int, hi: int) -> Column:
    """Character n-grams of an array column of words, each word padded with a space on both sides.

    A word not longer than n gives itself once and takes part in no larger n.
    """
    sizes = f"sequence({lo}, least({hi}, greatest({lo}, length(p))))"
    starts = "sequence(1, greatest(1, length(p) - n + 1))"
    return F.expr(
        f"flatten(transform({words}, w -> flatten(transform(array(concat(' ', w, ' ')), p -> "
        f"flatten(transform({sizes}, n -> transform({starts}, at -> substring(p, at, n))))))))"
    )
