"""From a table with a name column to a mapping of names and the resolved table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namefold.config import ResolveConfig
from namefold.operators.names import counted_cleaning_map, one_per_key
from namefold.plans.cluster import cluster_names
from namefold.workspace import Workspace

MAPPING_COLUMNS = ("original_name", "cleaned_name", "cluster_id", "representative_name")


def attach_clusters(cleaned: DataFrame, clusters: DataFrame) -> DataFrame:
    """The cleaning map with cluster columns; a name that cleans to nothing keeps null ones.

    Blank names have no cluster by definition. They skip the join, so however many there are, they do
    not pile up on one key.
    """
    blank = F.col("cleaned_name") == ""
    found = cleaned.filter(~blank).join(clusters, "cleaned_name", "left")
    unmatched = cleaned.filter(blank).select(
        "*", F.lit(None).cast("bigint").alias("cluster_id"), F.lit(None).cast("string").alias("representative_name")
    )
    return found.unionByName(unmatched).select(*MAPPING_COLUMNS)


def mapping_table(cleaned: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per distinct original name: ``MAPPING_COLUMNS``."""
    return one_per_key(attach_clusters(cleaned, clusters), "original_name")


def measured_bytes(mapping: DataFrame) -> int:
    """Size of the mapping in memory, from its text lengths and a fixed cost per row."""
    texts = sum(
        (F.coalesce(F.octet_length(c), F.lit(0)) for c in ("original_name", "cleaned_name", "representative_name")),
        F.lit(0),
    )
    return mapping.agg(F.coalesce(F.sum(texts + 96), F.lit(0)).alias("bytes")).first()["bytes"]


# A name is hot if it fills more than one in so many rows; so there are fewer hot names than this.
HOT_NAME_SHARE = 10_000


def merge_back(
    df: DataFrame,
    mapping: DataFrame,
    name_col: str,
    broadcast_bytes: int = ResolveConfig.broadcast_bytes,
    ws: Workspace | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Every input row with its cleaned name, cluster and representative; the row count is unchanged.

    A mapping below ``broadcast_bytes`` is broadcast and the input is not moved at all. ``counts``, rows per
    ``original_name`` as ``n``, saves a pass over the names with a larger one.
    """
    side = mapping.select(*MAPPING_COLUMNS)
    if measured_bytes(side) > broadcast_bytes:
        return _merge_large(df, side, name_col, broadcast_bytes, ws or Workspace(df.sparkSession), counts)
    matches = df[name_col].cast("string") == side["original_name"]
    return df.join(F.broadcast(side), matches, "left").drop("original_name")


def hot_names(mapping: DataFrame, counts: DataFrame, broadcast_bytes: int, ws: Workspace) -> DataFrame | None:
    """The mapping rows of the hot names, fewer than ``HOT_NAME_SHARE``; None if their texts do not fit."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often = counts.filter(F.col("n") * HOT_NAME_SHARE > total)
    hot, _ = ws.save(mapping.join(often.select("original_name"), "original_name", "left_semi"), "hot_names")
    return hot if measured_bytes(hot) <= broadcast_bytes else None


def _merge_large(
    df: DataFrame, mapping: DataFrame, name_col: str, broadcast_bytes: int, ws: Workspace, counts: DataFrame | None
) -> DataFrame:
    """One scan and one join. Rows of hot names are filled from a broadcast table.

    They, and rows without a name, then get a key that is spread and matches nothing. Hot names whose texts
    are too long to broadcast stay in the join, where adaptive execution splits them.
    """
    if counts is None:
        counts, _ = ws.save(counted_cleaning_map(df, name_col).select("original_name", "n"), "counts")
    hot = hot_names(mapping, counts, broadcast_bytes, ws)
    rows = df.withColumn("_nf_name", F.col(name_col).cast("string"))
    skip = F.col("_nf_name").isNull()
    filled = {c: F.col(f"_nf_to_{c}") for c in MAPPING_COLUMNS[1:]}
    if hot is not None:
        known = hot.select(*(F.col(c).alias(f"_nf_{c}") for c in MAPPING_COLUMNS))
        rows = rows.join(F.broadcast(known), F.col("_nf_name") == F.col("_nf_original_name"), "left")
        skip = skip | F.col("_nf_original_name").isNotNull()
        is_hot = F.col("_nf_original_name").isNotNull()
        filled = {c: F.when(is_hot, F.col(f"_nf_{c}")).otherwise(v) for c, v in filled.items()}
    rows = rows.withColumn("_nf_spread", F.when(skip, 1 + F.monotonically_increasing_id() % 4096).otherwise(0))
    rows = rows.withColumn("_nf_key", F.when(F.col("_nf_spread") > 0, "").otherwise(F.col("_nf_name")))
    side = mapping.select(*(F.col(c).alias(f"_nf_to_{c}") for c in MAPPING_COLUMNS), F.lit(0).cast("bigint").alias("_nf_at"))
    matches = (F.col("_nf_key") == F.col("_nf_to_original_name")) & (F.col("_nf_spread") == F.col("_nf_at"))
    return rows.join(side, matches, "left").select(*df.columns, *(v.alias(c) for c, v in filled.items()))


@dataclass(frozen=True)
class Resolution:
    """Results that read the tables of ``ws``; close it, or leave the ``with`` block, when they are written."""

    mapping: DataFrame
    final: DataFrame
    ws: Workspace

    def close(self) -> None:
        self.ws.close()

    def __enter__(self) -> "Resolution":
        return self

    def __exit__(self, *_exc) -> None:
        self.close()


def resolve(
    df: DataFrame, name_col: str, cfg: ResolveConfig | None = None, ws: Workspace | None = None
) -> Resolution:
    """Clean, cluster and map the names of ``df`` and join the result onto every row."""
    cfg = cfg or ResolveConfig()
    ws = ws or Workspace(df.sparkSession)
    # The distinct names are read three times; the input itself only here and in the final join.
    counted, _ = ws.save(counted_cleaning_map(df, name_col, cfg), "cleaned")
    cleaned = counted.drop("n")
    clusters = cluster_names(cleaned, cfg=cfg, ws=ws)
    # The cleaning map is distinct per original and the clusters per cleaned name: nothing to dedupe.
    mapping, _ = ws.save(attach_clusters(cleaned, clusters), "mapping")
    final = merge_back(df, mapping, name_col, cfg.broadcast_bytes, ws, counted.select("original_name", "n"))
    return Resolution(mapping, final, ws)


def largest_clusters(mapping: DataFrame, clusters: int = 5, samples: int = 5) -> DataFrame:
    """The clusters with most original names, each with its first few original names."""
    known = mapping.filter(F.col("cluster_id").isNotNull())
    top = (
        known.groupBy("cluster_id", "representative_name")
        .agg(F.count(F.lit(1)).alias("members"))
        .orderBy(F.desc("members"), "cluster_id")
        .limit(clusters)
    )
    in_order = Window.partitionBy("cluster_id").orderBy("original_name")
    return (
        known.select("cluster_id", "original_name")
        .join(F.broadcast(top), "cluster_id")
        .withColumn("sample", F.row_number().over(in_order))
        .filter(F.col("sample") <= samples)
        .select("cluster_id", "representative_name", "members", "sample", "original_name")
    )


def browse_mapping(mapping: DataFrame) -> DataFrame:
    """The mapping in cluster order, for reading."""
    return mapping.orderBy("cluster_id", "original_name")
