"""The four rounds of grouping: precision, verification, recall, final merge.

Verification belongs to each round, so the work is one function, run on all names and then twice on the
representatives that are left. Ids never change: a representative keeps its id from round to round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namefold.config import PassParams, ResolveConfig
from namefold.operators import components, features, names, neighbours, simjoin, verify
from namefold.workspace import Workspace


@dataclass(frozen=True)
class Model:
    """Vectors of the token groups of one round, and what is known about their sizes."""

    members: DataFrame  # id, gid, size, cleaned_name, token_key
    shared: int  # names in groups of more than one
    grams: features.GramModel
    weights: DataFrame  # not written; recomputed where it is read
    vectors: DataFrame
    vector_bytes: int


@dataclass(frozen=True)
class PassResult:
    labels: DataFrame  # id, cleaned_name, token_key, root (component), label (after verification)
    clusters: int


def _unlink_empty(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """Names without any usable gram resemble nothing, not even names of the same tokens."""
    empty = (
        names.first_of_group(members)
        .filter(F.col("size") > 1)
        .join(vectors.select("gid"), "gid", "left_anti")
        .select("gid", F.lit(True).alias("empty"))
    )
    gid = F.when(F.coalesce("empty", F.lit(False)), F.col("id")).otherwise(F.col("gid"))
    return members.join(empty, "gid", "left").select("id", gid.alias("gid"), "size", "cleaned_name", "token_key")


def fit_model(
    numbered: DataFrame, documents: int, params: PassParams, cfg: ResolveConfig, ws: Workspace
) -> Model:
    """TF-IDF vectors of ``numbered`` (id, cleaned_name, token_key), fitted on these names alone."""
    members, shared = names.token_groups(numbered, ws)
    terms = features.term_counts(names.first_of_group(members), documents, params.ngram_range)
    grams = features.fit(terms, documents, cfg.max_df, ws)
    weights = features.weighted_terms(terms, grams, cfg.broadcast_bytes)
    vectors, seen = ws.save(
        features.vectors(weights, params.threshold),
        "vectors",
        bytes=F.coalesce(F.sum(F.octet_length("terms") + 96), F.lit(0)),
    )
    if shared and grams.dropped:
        members = _unlink_empty(members, vectors)
    return Model(members, shared, grams, weights, vectors, seen["bytes"])


def neighbour_ranking(model: Model, params: PassParams, cfg: ResolveConfig, ws: Workspace) -> DataFrame:
    pairs = simjoin.cosine_pairs(
        model.vectors, params.threshold, cfg, ws, model.grams.max_df, model.vector_bytes
    )
    return neighbours.ranked_neighbours(pairs, model.vectors, model.members, params.top_n, model.shared)


def group_components(model: Model, params: PassParams, cfg: ResolveConfig, ws: Workspace) -> DataFrame:
    ranking = neighbour_ranking(model, params, cfg, ws)
    edges, _ = ws.save(neighbours.group_edges(ranking), "edges")
    return components.connected_components(edges, ws)


def cluster_pass(
    numbered: DataFrame, documents: int, params: PassParams, cfg: ResolveConfig, ws: Workspace
) -> PassResult:
    """One round over distinct names: similarity graph, components, verification."""
    with ws.scratch() as scratch:
        model = fit_model(numbered, documents, params, cfg, scratch)
        linked = group_components(model, params, cfg, scratch)
        verdicts = verify.anchor_verdicts(linked, model.members, params.fuzz)
        labels, seen = ws.save(
            verify.split_weak_members(model.members, verdicts),
            "labels",
            clusters=F.count_if(F.col("id") == F.col("label")),
        )
    return PassResult(labels, seen["clusters"])


def representatives_of(result: PassResult) -> DataFrame:
    """The names that stand for a cluster: those labelled with their own id."""
    return result.labels.filter(F.col("id") == F.col("label")).select("id", "cleaned_name", "token_key")


def run_rounds(cleaned: DataFrame, cfg: ResolveConfig, ws: Workspace, upto: int = 3) -> list[PassResult]:
    """The first ``upto`` rounds over the distinct, non-blank names in ``cleaned``."""
    numbered, documents = names.number_names(names.unique_cleaned_names(cleaned), ws)
    results: list[PassResult] = []
    for params in (cfg.precision, cfg.recall, cfg.merge)[:upto]:
        result = cluster_pass(numbered, documents, params, cfg, ws)
        results.append(result)
        numbered, documents = representatives_of(result), result.clusters
    return results


def compose_labels(first: DataFrame, following: DataFrame) -> DataFrame:
    """Carry labels one round further: name -> cluster -> cluster of the clusters."""
    renamed = following.select(F.col("id").alias("label"), F.col("label").alias("next"))
    return first.join(renamed, "label").select("id", "cleaned_name", F.col("next").alias("label"))


def dense_ids(reps: DataFrame, ws: Workspace) -> DataFrame:
    """Number clusters 0.. in the order of their representative, the same in every run.

    Sorted by range; each partition then only needs the number of rows before it. Only these offsets, one
    row per partition whatever the data, are summed in one place and broadcast.
    """
    row = F.col("at").bitwiseAND((1 << 33) - 1)
    sorted_reps, _ = ws.save(
        reps.orderBy("representative_name").select("*", F.monotonically_increasing_id().alias("at")), "ranked"
    )
    part = F.shiftright("at", 33)
    counts = sorted_reps.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    placed = sorted_reps.withColumn("part", part).join(F.broadcast(offsets), "part")
    return placed.withColumn("cluster_id", F.col("offset") + row).drop("at", "part", "offset")


def clusters_of(results: list[PassResult], ws: Workspace) -> DataFrame:
    """``(cleaned_name, cluster_id, representative_name)`` after the given rounds."""
    last = results[-1].labels
    reps = last.filter(F.col("id") == F.col("label")).select(
        "id", F.col("cleaned_name").alias("representative_name")
    )
    reps = dense_ids(reps, ws)
    # From the last round backwards: the later tables only hold representatives and stay small.
    final = reps
    for result in reversed(results):
        known = final.select(F.col("id").alias("label"), "cluster_id", "representative_name")
        final = result.labels.join(known, "label")
    return final.select("cleaned_name", "cluster_id", "representative_name")


def cluster_names(
    cleaned: DataFrame,
    threshold: float | None = None,
    ngram_range: tuple[int, int] | None = None,
    top_n: int | None = None,
    cfg: ResolveConfig | None = None,
    ws: Workspace | None = None,
) -> DataFrame:
    """Cluster the distinct non-blank values of ``cleaned_name``.

    The overrides apply to the first round; a falsy one means the default.
    """
    cfg = (cfg or ResolveConfig()).with_precision(threshold, ngram_range, top_n)
    ws = ws or Workspace(cleaned.sparkSession)
    return clusters_of(run_rounds(cleaned, cfg, ws), ws)
