"""Token-sort ratio: the share of two token-sorted names covered by their longest common subsequence."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from namefold.functions.kernels import lcs_in_chunks
from namefold.functions.text import token_key


@F.pandas_udf(IntegerType())
def lcs_length(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        yield pd.Series(lcs_in_chunks(a.fillna("").to_numpy(object), b.fillna("").to_numpy(object)))


def sorted_token_lcs(a: Column, b: Column) -> Column:
    """LCS length of two columns that already hold token keys."""
    return lcs_length(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Score 0..100 of two names, independent of the order of their tokens; 0 if one is null."""
    key_a, key_b = token_key(a), token_key(b)
    total = F.length(key_a) + F.length(key_b)
    score = F.when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs_length(key_a, key_b) / total)
    return F.coalesce(score, F.lit(0.0))


def lcs_upper_bound(a: Column, b: Column) -> Column:
    """An upper bound of the LCS length of two strings, native: the size of the multiset intersection of their
    code points, sum over the distinct code points ``c`` of ``a`` of ``min(count_a(c), count_b(c))``. A common
    subsequence uses each code point at most as often as either string holds it, so the LCS never exceeds it.
    Null if either is null.
    """
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    points = F.array_distinct(F.regexp_extract_all(a, F.lit("(?s)."), 0))
    shared = F.aggregate(points, F.lit(0), lambda acc, c: acc + F.least(count(a, c), count(b, c)))
    return F.when(a.isNotNull() & b.isNotNull(), shared)
