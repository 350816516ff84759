"""Mixing sources to target weights: repetition rates per source, copies per document.

Built-in functions only. Tokens are counted once, in one scan, and summed per source before the exchange, so a
source with a third of all rows costs one row per task. Targets are a water level: a source gets its weight times
the level, but never more than ``cap`` times its own size. With the sources ordered by cap over weight, whether a
source is full follows from the running sums before it, so the level needs two sorted passes over one row per
source, not a loop. Running sums are kept per range of the order and shifted by the sums of the ranges before it.

Every document is emitted floor(rate) times, and once more if its hash-seeded draw falls below the fraction, so the
expected words of a source are its target and reruns agree.

Nulls: a null text has size 0; a null source is a source of its own, after all others; a document without an id
draws by its text. Repeated rows draw alike. An empty table gives an empty result. Other columns of the input pass
through ``mix``; its own columns start with ``_mix_`` and are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namefold.llm.words import SPACED_WORD
from namefold.workspace import Workspace

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20_260


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def draw_of(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the document only."""
    bits = F.xxhash64(F.coalesce(doc_id.cast("bigint"), F.xxhash64(text)), F.lit(seed))
    return F.shiftrightunsigned(bits, 11).cast("double") * F.lit(2.0**-53)


def running(df: DataFrame, order: list[Column], ws: Workspace, **sums: Column) -> DataFrame:
    """Adds the sums of ``sums`` over all rows up to and including each row in the given order."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_row", F.monotonically_increasing_id())
    placed, _ = ws.save(placed.withColumn("_range", F.shiftright("_row", 33)), "ranges")
    # One row per range; there are at most as many ranges as shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("_range").agg(*(F.sum(c).alias(f"_{k}") for k, c in sums.items()))
    ranges = ranges.select("_range", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    inside = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    found = placed.join(ranges, "_range")
    found = found.select("*", *((F.sum(c).over(inside) + F.col(f"_{k}")).alias(k) for k, c in sums.items()))
    return found.drop("_row", "_range", *(f"_{k}" for k in sums))


def source_targets(
    sizes: DataFrame, ws: Workspace, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, source_size)``.

    Sources take ``weights`` in turn, by code point, null last, and share the total by weight; what exceeds ``cap``
    times a source's size is shared among the others.
    """
    ranked = running(sizes, [F.col("source").asc_nulls_last()], ws, rank=F.lit(1).cast("bigint"))
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (((F.col("rank") - 1) % len(weights)) + 1).cast("int"))
    ranked = ranked.withColumn("weight", turn).withColumn("limit", (F.col("source_size") * cap).cast("double"))
    order = [F.col("limit") / F.col("weight"), F.col("rank")]
    summed = running(ranked, order, ws, limits=F.col("limit"), weighed=F.col("weight"))
    summed, _ = ws.save(summed, "water")
    whole = summed.agg(F.sum("source_size").cast("double").alias("size"), F.sum("weight").alias("weight")).first()
    left_size = F.lit(whole["size"]) - F.col("limits") + F.col("limit")
    left_weight = F.lit(whole["weight"]) - F.col("weighed") + F.col("weight")
    full = F.col("limit") * left_weight <= F.col("weight") * left_size
    filled = summed.withColumn("full", full)
    free = filled.agg(
        F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).alias("used"),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).alias("weight"),
    ).first()
    level = (whole["size"] - free["used"]) / free["weight"] if free["weight"] else 0.0
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least(F.col("weight") * F.lit(level), F.col("limit")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        filled.withColumn("target", target)
        .withColumn("rate", F.least(rate, F.lit(float(cap))))
        .select("source", "source_size", "target", "rate")
    )


def copies_of(rate: Column, draw: Column) -> Column:
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def with_rates(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds the columns of ``targets`` by source; null matches null."""
    found = targets.withColumnRenamed("source", "_mix_source")
    return docs.join(found, F.col("source").eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")


def document_takes(docs: DataFrame, ws: Workspace) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per document; ``taken`` counts a word once per copy."""
    sized, _ = ws.save(
        docs.select(
            "doc_id", "source", size_of(F.col("text")).alias("size"), draw_of(F.col("doc_id"), F.col("text")).alias("draw")
        ),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, _ = ws.save(source_targets(sizes, ws), "targets")
    taken = F.col("size") * copies_of(F.col("rate"), F.col("draw"))
    return with_rates(sized, targets).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, ws: Workspace) -> DataFrame:
    """The documents of the mix: the rows of ``docs``, each as often as it is taken."""
    sizes = docs.groupBy("source").agg(F.sum(size_of(F.col("text"))).alias("source_size"))
    targets, _ = ws.save(source_targets(sizes, ws).select("source", F.col("rate").alias("_mix_rate")), "targets")
    copies = copies_of(F.col("_mix_rate"), draw_of(F.col("doc_id"), F.col("text")))
    repeated = with_rates(docs, targets).withColumn("_mix_copies", copies).filter("_mix_copies > 0")
    repeated = repeated.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return repeated.select(*docs.columns)
