"""Counts that describe the data at each stage, as one-row (or one row per round) tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.functions.cleaning import WS
from namefold.plans.cluster import PassResult


def _percent(part: Column, whole: Column) -> Column:
    return 100.0 * part / F.nullif(whole, F.lit(0))


def source_profile(df: DataFrame, name_col: str) -> DataFrame:
    """Rows, distinct names, and by how much working on distinct names shrinks the input."""
    # Counted per name first: one pass, aggregated before the exchange, nulls included in the rows.
    per_name = df.groupBy(F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    counts = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("name").alias("unique_names")
    )
    saved = F.col("total_rows") - F.col("unique_names")
    return counts.withColumn("reduction_pct", _percent(saved, F.col("total_rows")))


def is_modified(original: Column, cleaned: Column) -> Column:
    """Did cleaning change more than letter case and outer white space?"""
    return F.regexp_replace(F.lower(original), rf"(?U)\A{WS}+|{WS}+\z", "") != cleaned


def cleaning_profile(cleaned: DataFrame) -> DataFrame:
    """Names changed by cleaning and distinct cleaned names, the empty one included."""
    counts = cleaned.agg(
        F.count(F.lit(1)).alias("names"),
        F.count_if(is_modified(F.col("original_name"), F.col("cleaned_name"))).alias("modified"),
        F.countDistinct("cleaned_name").alias("unique_cleaned"),
    )
    return counts.withColumn("modified_pct", _percent(F.col("modified"), F.col("names")))


def mapping_profile(mapping: DataFrame) -> DataFrame:
    """Entries, clusters and representatives; nulls are not counted."""
    per_cluster = mapping.groupBy("cluster_id", "representative_name").agg(F.count(F.lit(1)).alias("n"))
    # A cluster has one representative and a representative one cluster, so one pass gives both counts.
    return per_cluster.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("entries"),
        F.count("cluster_id").alias("clusters"),
        F.count("representative_name").alias("representatives"),
    )


def tfidf_stats(weights: DataFrame, documents: int) -> DataFrame:
    """Shape and density of the vectors; each one counts for all names that share it."""
    per_gram = weights.groupBy("gram").agg(F.sum("size").alias("nonzeros"))
    counts = per_gram.agg(
        F.lit(documents).cast("bigint").alias("names"),
        F.count(F.lit(1)).alias("features"),
        F.coalesce(F.sum("nonzeros"), F.lit(0)).alias("nonzeros"),
    )
    cells = F.col("names") * F.col("features")
    return counts.withColumn("density", F.col("nonzeros") / F.nullif(cells, F.lit(0)))


def pass_summary(results: list[PassResult]) -> DataFrame:
    """Per round: names going in, components, names split off, clusters coming out."""
    rows = []
    for number, result in enumerate(results, start=1):
        counts = result.labels.agg(
            F.count(F.lit(1)).alias("names"),
            F.count_if(F.col("id") == F.col("root")).alias("components"),
            F.count_if(F.col("label") != F.col("root")).alias("split_names"),
            F.count_if(F.col("id") == F.col("label")).alias("clusters"),
        )
        rows.append(
            counts.select(
                F.lit(number).alias("round"),
                "*",
                (F.col("names") - F.col("clusters")).alias("merged_names"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def run_summary(df: DataFrame, mapping: DataFrame, final: DataFrame) -> DataFrame:
    """Rows in and out, mapping entries, clusters."""
    entries = mapping.agg(
        F.count(F.lit(1)).alias("mapping_entries"), F.countDistinct("cluster_id").alias("clusters")
    )
    rows_in = df.agg(F.count(F.lit(1)).alias("input_rows"))
    rows_out = final.agg(F.count(F.lit(1)).alias("output_rows"))
    # Three single rows side by side.
    tagged = [d.withColumn("k", F.lit(0)) for d in (rows_in, entries, rows_out)]
    return tagged[0].join(tagged[1], "k").join(tagged[2], "k").drop("k")
