"""Exact cosine self-join of sparse unit vectors above a threshold.

Candidates come from an inverted index over vector prefixes. Grams are ordered rare first. If ``g`` is
the first gram two vectors share, their cosine is at most ``tail_a(g) * tail_b(g)``, the product of the
norms from ``g`` on (Bayardo et al., WWW 2007; Anastasiu and Karypis, ICDE 2014). So a pair above ``t``
meets in a gram where that product exceeds ``t``; then one of the two tails exceeds ``sqrt(t)``. Entries
with such a tail are "early"; the join is early entries against all prefix entries. Frequent grams sit at
the end of the order and rarely get into a prefix at all. Every candidate is verified by its dot product,
so the result has all pairs above the threshold and nothing else.

Residual bound at the first shared gram: there the cosine is ``w_a(g) w_b(g)`` plus what the parts after ``g``
share, at most ``rest_a(g) rest_b(g)``, the product of their norms. A meeting is kept only if this sum exceeds ``t``.
At a later shared gram the sum is no bound (earlier grams are not counted), but a pair above ``t`` always passes at
its first shared gram, which is a meeting, and pairs are taken distinct; so the test drops no pair above ``t``.
The sum never exceeds ``tail_a tail_b`` (Cauchy-Schwarz in two dimensions), so it is the tighter test.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namefold.config import ResolveConfig
from namefold.functions.kernels import PLANES, WORDS, dot_products
from namefold.workspace import Workspace

DECIMALS = 9  # similarities are rounded before they are compared or ranked
_SLACK = 1e-6


SKETCH = ("unit", *(f"s{i}" for i in range(PLANES * WORDS)))


def index_entries(vectors: DataFrame) -> DataFrame:
    entries = vectors.select("gid", *SKETCH, F.explode("prefix").alias("e"))
    return entries.select("gid", *SKETCH, "e.gram_id", "e.tail", "e.w", "e.rest")


def _sketch_bound() -> str:
    """Upper bound of the cosine of ``x`` and ``y``: the dot product of their levels, plane by plane."""
    products = [
        f"shiftleft(bit_count(x.s{p * WORDS + w} & y.s{q * WORDS + w}), {p + q})"
        for p in range(PLANES)
        for q in range(PLANES)
        for w in range(WORDS)
    ]
    return f"x.unit * y.unit * ({' + '.join(products)})"


def block_counts(entries: DataFrame, early_tail: float, block_rows: int) -> DataFrame:
    """Grams whose entries do not fit one join group, with the number of blocks for both sides."""
    early = F.count_if(F.col("tail") > early_tail)
    total = F.count(F.lit(1))
    blocks = entries.groupBy("gram_id").agg(early.alias("n_early"), total.alias("n_all"))
    return blocks.filter((F.col("n_all") > block_rows) & (F.col("n_early") > 0)).select(
        "gram_id",
        F.ceil(F.col("n_early") / block_rows).alias("early_blocks"),
        F.ceil(F.col("n_all") / block_rows).alias("all_blocks"),
    )


def candidate_pairs(
    vectors: DataFrame, threshold: float, cfg: ResolveConfig, ws: Workspace, most_entries: int
) -> DataFrame:
    """Distinct pairs ``(a, b)``, ``a < b``, that may exceed ``threshold``.

    ``most_entries`` bounds the entries of one gram. If it is above the block size, frequent grams are
    counted and cut into blocks: an early entry goes to each block of the other side and the reverse, so
    any two entries still meet exactly once, but in join groups of bounded size that spread over tasks.
    """
    early_tail = math.sqrt(threshold) - _SLACK
    entries = index_entries(vectors)
    left = entries.filter(F.col("tail") > early_tail)
    right = entries
    keys = ["gram_id"]
    if most_entries > cfg.gram_block_rows:
        hot, seen = ws.save(
            block_counts(entries, early_tail, cfg.gram_block_rows), "hot_grams", rows=F.count(F.lit(1))
        )
        if seen["rows"]:
            if seen["rows"] * 24 <= cfg.broadcast_bytes:
                hot = F.broadcast(hot)
            keys = ["gram_id", "early_block", "all_block"]
            left = _spread(left, hot, own="early", other="all")
            right = _spread(right, hot, own="all", other="early")
    left, right = left.alias("x"), right.alias("y")
    on = " and ".join(f"x.{k} = y.{k}" for k in keys)
    met = left.join(
        right,
        F.expr(
            f"""{on} and x.w * y.w + x.rest * y.rest > {threshold - _SLACK:.17e}D
            -- two early entries meet from both sides; one of the two is enough
            and (y.tail <= {early_tail:.17e}D or x.gid < y.gid)
            and {_sketch_bound()} > {threshold - _SLACK:.17e}D"""
        ),
    )
    return met.selectExpr("least(x.gid, y.gid) as a", "greatest(x.gid, y.gid) as b").distinct()


def _spread(entries: DataFrame, hot: DataFrame, own: str, other: str) -> DataFrame:
    """Place each entry in one block of its own side and copy it to all blocks of the other side."""
    own_blocks = F.coalesce(F.col(f"{own}_blocks"), F.lit(1))
    other_blocks = F.coalesce(F.col(f"{other}_blocks"), F.lit(1))
    return entries.join(hot, "gram_id", "left").select(
        *entries.columns,
        F.pmod(F.xxhash64("gid"), own_blocks).alias(f"{own}_block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), other_blocks - 1)).alias(f"{other}_block"),
    )


def verified_pairs(
    candidates: DataFrame, vectors: DataFrame, threshold: float, small: bool = False
) -> DataFrame:
    """Candidates with their exact cosine, kept strictly above ``threshold``.

    With ``small`` (vectors of a checked size) candidates stay where they are; otherwise they are placed by
    one side after the other.
    """
    sides = candidates
    for side in ("a", "b"):
        known = vectors.select(F.col("gid").alias(side), F.col("terms").alias(f"{side}_terms"))
        sides = sides.join(F.broadcast(known) if small else known, side)
    sides = sides.select("a", "b", "a_terms", "b_terms")
    dots = sides.mapInArrow(dot_products, "a bigint, b bigint, sim double")
    return dots.withColumn("sim", F.round("sim", DECIMALS)).filter(F.col("sim") > threshold)


def cosine_pairs(
    vectors: DataFrame,
    threshold: float,
    cfg: ResolveConfig,
    ws: Workspace,
    most_entries: int,
    vector_bytes: int,
) -> DataFrame:
    """All pairs ``(a, b, sim)``, ``a < b``, of vectors with cosine strictly above ``threshold``."""
    candidates = candidate_pairs(vectors, threshold, cfg, ws, most_entries)
    return verified_pairs(candidates, vectors, threshold, vector_bytes <= cfg.broadcast_bytes)
