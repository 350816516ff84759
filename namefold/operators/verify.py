"""Fuzzy verification: members too far from the anchor of their component leave it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namefold.functions.fuzzy import lcs_upper_bound, sorted_token_lcs
from namefold.operators.names import first_of_group


def anchor_verdicts(labels: DataFrame, members: DataFrame, min_score: int) -> DataFrame:
    """Per linked group ``(gid, root, weak)``: does it score below ``min_score`` against the anchor?

    Ids grow in anchor order, so the root of a component is its anchor. The score is the same for all
    names of a group. Compared as integers, so a score equal to the limit is exactly that.

    Sure verdicts are decided natively, without the LCS kernel: a group whose code-point multiset intersection with
    the anchor is already too small to reach ``min_score`` is weak, and one with the anchor's own key is not. Only
    the others are sent to the kernel (decided rows pass it empty strings, which cost nothing); ``native`` marks the
    rows decided without it. The verdicts are those of the kernel on every row.
    """
    keys = first_of_group(members).select("gid", "token_key")
    scored = (
        labels.withColumnRenamed("node", "gid")
        .join(keys, "gid")
        .join(keys.select(F.col("gid").alias("root"), F.col("token_key").alias("anchor_key")), "root")
        .select(
            "gid",
            "root",
            "anchor_key",
            "token_key",
            lcs_upper_bound(F.col("anchor_key"), F.col("token_key")).alias("bound"),
            (F.length("anchor_key") + F.length("token_key")).alias("total"),
        )
        .withColumn("sure_weak", F.col("bound") * 200 < F.col("total") * min_score)
        .withColumn("same", F.col("anchor_key") == F.col("token_key"))
        .withColumn("native", F.coalesce(F.col("sure_weak") | F.col("same"), F.lit(False)))
    )
    open_a = F.when(~F.col("native"), F.col("anchor_key")).otherwise(F.lit(""))
    open_b = F.when(~F.col("native"), F.col("token_key")).otherwise(F.lit(""))
    lcs = sorted_token_lcs(open_a, open_b)
    weak = (
        F.when(F.col("sure_weak"), F.lit(True))
        .when(F.col("same"), F.lit(False))
        .otherwise(lcs * 200 < F.col("total") * min_score)
    )
    return scored.select("gid", "root", weak.alias("weak"), "native")


def split_weak_members(members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Names with component root and verified label: ``(id, cleaned_name, token_key, root, label)``.

    Each weak name becomes a cluster of its own; weak names are not grouped with each other again.
    """
    judged = members.join(verdicts, "gid", "left").withColumn("root", F.coalesce("root", "gid"))
    weak = F.coalesce("weak", F.lit(False))
    label = F.when(weak, F.col("id")).otherwise(F.col("root"))
    return judged.select("id", "cleaned_name", "token_key", "root", label.alias("label"))


def representatives(df: DataFrame, name_col: str = "cleaned_name", cluster_col: str = "cluster_id") -> DataFrame:
    """The shortest name per cluster, ties in code-point order: ``(cluster_col, representative_name)``."""
    best = F.min(F.struct(F.length(name_col).alias("length"), F.col(name_col).alias("name")))
    return df.groupBy(cluster_col).agg(best.alias("best")).select(
        cluster_col, F.col("best.name").alias("representative_name")
    )


def attach_representatives(
    df: DataFrame, name_col: str = "cleaned_name", cluster_col: str = "cluster_id"
) -> DataFrame:
    """Every member with the representative of its cluster."""
    return df.join(representatives(df, name_col, cluster_col), cluster_col, "left")
