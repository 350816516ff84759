"""Distinct names, their cleaned forms, and stable ids in representative order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.config import ResolveConfig
from namefold.functions.cleaning import clean_name
from namefold.functions.text import token_key, tokens
from namefold.workspace import Workspace


def unique_names(df: DataFrame, name_col: str) -> DataFrame:
    """Distinct non-null names as they are: no trimming, case-sensitive."""
    name = F.col(name_col).cast("string")
    return df.filter(F.col(name_col).isNotNull()).select(name.alias("original_name")).distinct()


def _cleaned(cfg: ResolveConfig | None) -> Column:
    cfg = cfg or ResolveConfig()
    return clean_name(F.col("original_name"), cfg.honorifics, cfg.junk_words)


def cleaning_map(df: DataFrame, name_col: str, cfg: ResolveConfig | None = None) -> DataFrame:
    """One row per distinct original name with its cleaned form."""
    return unique_names(df, name_col).withColumn("cleaned_name", _cleaned(cfg))


def counted_cleaning_map(df: DataFrame, name_col: str, cfg: ResolveConfig | None = None) -> DataFrame:
    """The cleaning map with the number of rows of each name, ``n``; one pass over the names."""
    name = F.col(name_col).cast("string").alias("original_name")
    counts = df.filter(F.col(name_col).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("original_name", _cleaned(cfg).alias("cleaned_name"), "n")


def not_blank(name: Column) -> Column:
    return name.isNotNull() & (F.size(tokens(name)) > 0)


def unique_cleaned_names(cleaned: DataFrame, name_col: str = "cleaned_name") -> DataFrame:
    """Distinct cleaned names, without null and blank ones."""
    return (
        cleaned.select(F.col(name_col).alias("cleaned_name"))
        .filter(not_blank(F.col("cleaned_name")))
        .distinct()
    )


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key; meant for rows whose other columns depend on the key alone."""
    return df.dropDuplicates(list(keys))


def number_names(cleaned: DataFrame, ws: Workspace) -> tuple[DataFrame, int]:
    """Give every distinct name an id that grows with (length, name).

    The order is the one representatives are chosen by, so "smallest id of a group" and "representative
    of a group" are the same thing from here on. Written at once: the ids must not be computed twice.
    """
    ordered = cleaned.select("cleaned_name", token_key(F.col("cleaned_name")).alias("token_key")).orderBy(
        F.length("cleaned_name"), "cleaned_name"
    )
    names, seen = ws.save(
        ordered.select(F.monotonically_increasing_id().alias("id"), "cleaned_name", "token_key"),
        "names",
        rows=F.count(F.lit(1)),
    )
    return names, seen["rows"]


def token_groups(names: DataFrame, ws: Workspace) -> tuple[DataFrame, int]:
    """Attach to each name the group of names made of the same tokens.

    ``gid`` is the smallest id of the group and ``size`` its number of names. Such names have the same
    vector and the same fuzzy score against anything, so the costly steps run once per group; a group
    that holds a large share of all names costs no more than a single name. Also returns how many names
    are in groups of more than one.
    """
    groups = names.groupBy("token_key").agg(F.min("id").alias("gid"), F.count(F.lit(1)).alias("size"))
    # Written: with a plain table on either side Spark can split the names of a hot group. Names alone
    # in their group match nothing.
    groups, _ = ws.save(groups.filter(F.col("size") > 1), "token_groups")
    members = names.join(groups, "token_key", "left").select(
        "id",
        F.coalesce("gid", "id").alias("gid"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("size"),
        "cleaned_name",
        "token_key",
    )
    members, seen = ws.save(members, "members", shared=F.count_if(F.col("size") > 1))
    return members, seen["shared"]


def first_of_group(members: DataFrame) -> DataFrame:
    return members.filter(F.col("id") == F.col("gid"))
