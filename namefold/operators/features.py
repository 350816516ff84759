"""TF-IDF over character n-grams, as aggregations in long form.

Input rows are ``(gid, cleaned_name, size)``: ``size`` names share this vector and all count as documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namefold.functions.kernels import PLANES, WORDS, pack_vectors
from namefold.functions.text import char_wb_grams, tokens
from namefold.workspace import Workspace


@dataclass(frozen=True)
class GramModel:
    """The fitted model: one row per kept gram, ``gram_id`` ascending from rare to frequent."""

    table: DataFrame  # gram, gram_id, df
    documents: int
    kept: int
    dropped: int
    max_df: int


def name_grams(groups: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    """One row per n-gram occurrence."""
    lo, hi = ngram_range
    words = groups.select("gid", "size", tokens(F.lower("cleaned_name")).alias("words"))
    return words.select("gid", "size", F.explode(char_wb_grams("words", lo, hi)).alias("gram"))


def _tasks(spark: SparkSession, names: int) -> int:
    """Tasks for exploding ``names`` names: all slots once it is worth it, later a bounded load per task.

    Set here because a name is small and its grams are many: sizing by input bytes would give a few huge
    tasks.
    """
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(slots, names // 1000), names // 50_000)


def term_counts(groups: DataFrame, names: int, ngram_range: tuple[int, int]) -> DataFrame:
    """Occurrences per (name, gram).

    The names are placed by id before they are exploded, so the count needs no exchange of the grams.
    """
    placed = groups.repartition(_tasks(groups.sparkSession, names), "gid")
    grams = name_grams(placed, ngram_range)
    return grams.groupBy("gid", "size", "gram").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(terms: DataFrame) -> DataFrame:
    return terms.groupBy("gram").agg(F.sum("size").alias("df"))


def is_kept(df: Column, documents: int, max_df: float) -> Column:
    return df <= F.lit(float(max_df) * documents)


def smooth_idf(df: Column, documents: int) -> Column:
    return F.log((1.0 + documents) / (1.0 + df)) + 1.0


def sublinear_tf(tf: Column) -> Column:
    return 1.0 + F.log(tf.cast("double"))


def fit(terms: DataFrame, documents: int, max_df: float, ws: Workspace) -> GramModel:
    """Document frequencies with ids in (df, gram) order; too frequent grams are left out."""
    kept = is_kept(F.col("df"), documents, max_df)
    # Dropped grams sort last, so leaving them out when the table is read does not disturb the ids.
    numbered = document_frequencies(terms).orderBy("df", "gram")
    table, seen = ws.save(
        numbered.select("gram", F.monotonically_increasing_id().alias("gram_id"), "df"),
        "grams",
        kept=F.count_if(kept),
        dropped=F.count_if(~kept),
        max_df=F.max(F.when(kept, F.col("df"))),
    )
    return GramModel(table.filter(kept), documents, seen["kept"], seen["dropped"], seen["max_df"] or 0)


_MODEL_ROW_BYTES = 64


def _with_model(terms: DataFrame, model: GramModel, broadcast_bytes: int) -> DataFrame:
    """Terms with the id and frequency of their gram; terms of dropped grams disappear.

    A model below the limit is broadcast. Of a larger one the most frequent grams are, since they make up
    most terms and would be hot keys; only terms of the rarer grams are shuffled to theirs.
    """
    room = broadcast_bytes // _MODEL_ROW_BYTES
    if model.kept <= room:
        return terms.join(F.broadcast(model.table), "gram")
    cut = model.table.agg(F.percentile_approx("df", 1 - room / model.kept).alias("df")).first()["df"]
    frequent = model.table.filter(F.col("df") > cut)
    if frequent.count() > 2 * room:  # the percentile is approximate
        return terms.join(model.table, "gram")
    in_place = terms.join(F.broadcast(frequent), "gram")
    rarer = terms.join(F.broadcast(frequent.select("gram")), "gram", "left_anti")
    return in_place.unionByName(rarer.join(model.table.filter(F.col("df") <= cut), "gram"))


def weighted_terms(terms: DataFrame, model: GramModel, broadcast_bytes: int) -> DataFrame:
    """L2-normalised weights: ``(gid, size, gram, gram_id, w, tail)``.

    ``tail`` is the norm of the part of the vector from this gram on, rare grams first. With the whole model
    broadcast, everything stays where :func:`term_counts` put it.
    """
    raw = _with_model(terms, model, broadcast_bytes).select(
        "gid",
        "size",
        "gram",
        "gram_id",
        (sublinear_tf(F.col("tf")) * smooth_idf(F.col("df"), model.documents)).alias("raw"),
    )
    from_end = Window.partitionBy("gid").orderBy(F.desc("gram_id"))
    square = F.col("raw") * F.col("raw")
    everything = from_end.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = from_end.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return raw.select(
        "*",
        F.sum(square).over(so_far).alias("tail2"),
        F.sum(square).over(everything).alias("norm2"),
    ).select(
        "gid",
        "size",
        "gram",
        "gram_id",
        (F.col("raw") / F.sqrt("norm2")).alias("w"),
        F.sqrt(F.col("tail2") / F.col("norm2")).alias("tail"),
    )


def vectors(weights: DataFrame, threshold: float) -> DataFrame:
    """One row per vector: ``(gid, size, terms, unit, s0..s7, prefix)``.

    ``terms`` is the packed vector, 16 bytes per gram, and ``unit, s0..s7`` its sketch (see ``pack_vectors``).
    ``prefix``, rare grams first, holds the entries a pair above ``threshold`` must meet in (see
    ``simjoin``).
    """
    packed = weights.groupBy("gid", "size").agg(
        F.sort_array(F.collect_list(F.struct("gram_id", "w", "tail"))).alias("terms")
    )
    # ``rest`` is the norm of the part after the gram, so a pair first sharing it has at most ``w w' + rest rest'``.
    prefix = (
        "transform(filter(terms, t -> t.tail > {limit}), t -> struct(t.gram_id as gram_id, t.tail as tail, "
        "t.w as w, sqrt(greatest(t.tail * t.tail - t.w * t.w, 0D)) as rest))"
    )
    lists = packed.select(
        "gid",
        "size",
        F.col("terms.gram_id").alias("grams"),
        F.col("terms.w").alias("weights"),
        F.expr(prefix.format(limit=f"{threshold - 1e-6:.17e}D")).alias("prefix"),
    )
    return lists.mapInArrow(
        pack_vectors,
        "gid bigint, size bigint, terms binary, unit double, "
        + "".join(f"s{i} bigint, " for i in range(PLANES * WORDS))
        + "prefix array<struct<gram_id: bigint, tail: double, w: double, rest: double>>",
    )
