"""Top-n neighbours per name and the undirected edges they form.

Neighbours are ranked by similarity, ties by id. The name itself is ranked too (similarity 1) and takes
one of the slots. All names of a token group have the same ranking, so it is computed once per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _both_directions(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    turned = F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst"), "sim"),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst"), "sim"),
    )
    own = vectors.select(F.col("gid").alias("src"), F.col("gid").alias("dst"), F.lit(1.0).alias("sim"))
    return pairs.select(F.inline(turned)).unionByName(own)


def _first(ranked: DataFrame, top_n: int, key: str, *order) -> DataFrame:
    # row_number() <= n is cut per map task first, so a key with very many rows ships only n of them.
    place = Window.partitionBy(key).orderBy(*order)
    return ranked.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= top_n)


def ranked_neighbours(
    pairs: DataFrame, vectors: DataFrame, members: DataFrame, top_n: int, shared: int
) -> DataFrame:
    """The ``top_n`` names each group sees: ``(src, dst, id, sim, place)``.

    ``src`` and ``dst`` are groups, ``id`` is the name inside ``dst``. A group's first name is its gid, so
    a group that is not among the first ``top_n`` groups cannot place any name either; of the remaining
    groups at most ``top_n`` names can.
    """
    groups = _first(_both_directions(pairs, vectors), top_n, "src", F.desc("sim"), "dst")
    if not shared:
        return groups.withColumn("id", F.col("dst"))
    heads = _first(members.filter(F.col("size") > 1), top_n, "gid", "id")
    heads = heads.select(F.col("gid").alias("dst"), F.col("id").alias("head"))
    names = groups.drop("place").join(heads, "dst", "left")
    names = names.withColumn("id", F.coalesce("head", "dst")).drop("head")
    return _first(names, top_n, "src", F.desc("sim"), "id")


def group_edges(ranked: DataFrame) -> DataFrame:
    """Undirected edges between groups, ``(u, v)`` with ``u > v``: one side kept the other.

    Every name of ``src`` is linked to every ranked name, so a group is reached exactly when its first
    name is ranked, and names of one group are always in one component.
    """
    linked = ranked.filter((F.col("src") != F.col("dst")) & (F.col("id") == F.col("dst")))
    return linked.select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).distinct()


def topn_neighbours(ranked: DataFrame, members: DataFrame) -> DataFrame:
    """The ranking per name, without the name itself: ``(src, dst, sim)`` as name ids."""
    per_name = members.select(F.col("gid").alias("src"), F.col("id").alias("name")).join(ranked, "src")
    return per_name.filter(F.col("name") != F.col("id")).select(
        F.col("name").alias("src"), F.col("id").alias("dst"), "sim"
    )


def symmetric_edges(neighbours: DataFrame) -> DataFrame:
    """Undirected name edges ``(u, v)``, ``u > v``, if either side kept the other."""
    return neighbours.select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).distinct()
