"""Source divergence audit: how far each source's term distribution stands from its language and from the other sources.

Method: single-pass in-memory indexing, then sparse pair corrections.

1. **Index.** Each task reads its documents once and builds block postings in memory: for every (lang, source, term)
   the occurrences and the number of documents. When a block holds ``block_terms`` keys it is spilled as a run sorted by
   term and a new block begins, so a task's memory is bounded whatever its input.
2. **Merge.** Runs are exchanged by a hash shard of (lang, term) and sorted by key inside the shard; Spark's external
   sort merges its spilled runs through a heap. One streaming pass then adds up adjacent equal keys into frequencies,
   holding one key at a time.
3. **Vocabulary.** A lang keeps the ``V`` terms that stand in at least ``min_docs`` of its documents.
4. **Smoothed values.** A group (a lang and source, or a whole lang) with ``N`` kept occurrences gives a kept term of
   count ``c`` the value ``p = 1 + floor(scale * (c + alpha) / (N + alpha * V))``, computed exactly in decimals.
5. **Pair corrections.** A term absent from both groups of a pair adds ``|p0_a - p0_b|``, where ``p0`` is a group's value
   of a count of zero; so a pair starts at ``V * |p0_a - p0_b|``, and every term present in either group streams one
   correction, ``|p_a - p_b| - |p0_a - p0_b|``. Terms are grouped by (lang, term), which holds at most one row per
   source, and corrections are summed per pair before any exchange; no (group, term) table is ever made dense.

Output, one row per (lang, source, part, item): part ``pair`` has each other source of the lang as item and the sum
over kept terms of ``|p - q|`` as value (all of them ranked); part ``term`` has each kept term with a count above zero
in the group and ``p > q`` (``q`` the lang's value) as item, ``p - q`` as value, ranks up to ``top``. Ranks count from 1
per (lang, source, part), value descending, then item ascending by UTF-8 bytes. The term ranking is taken in two
steps (first within hash shards of a group, then over the shards' survivors) so a hot source is no single task.

Terms are runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` (ASCII letters and every non-ASCII character), A-Z lower-cased.
Edge cases: null text, lang or source is read as ''; a group without any kept term still gets its pair rows (its ``p0``
stands for every term), and no term rows; a lang with one source has no pair rows; ``V = 0`` gives pair values of 0;
repeated rows count as separate documents; very long texts are one document like any other; an empty table gives no
rows; other columns of the input are never read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namefold.workspace import Workspace

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between terms
MIN_DOCS = 30
SCALE = 1_000_000_000
ALPHA = 5
TOP = 50
BLOCK_TERMS = 1 << 18  # keys of one in-memory block before it is spilled as a run
SLICE_BYTES = 4 << 20  # text split and grouped at once
RANK_SHARDS = 64  # first-step shards of a group's term ranking
BROADCAST_BYTES = 32 << 20  # measured size of the per-lang source lists up to which they are broadcast
_RUN = "lang string, source string, term string, n bigint, docs bigint"


def _combined(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns(["lang", "source", "term", "n", "docs"])


def _postings(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one batch of documents, plus one empty term per group as its marker."""
    text = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
    pieces = pc.split_pattern_regex(text, pattern=_GAP)
    words, doc = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    nonempty = pc.greater(pc.binary_length(words), 0)
    per_doc = pa.table({"doc": doc.filter(nonempty), "term": words.filter(nonempty)}).group_by(["doc", "term"]).aggregate([("term", "count")])
    rows = pa.table({
        "lang": pc.take(batch.column("lang"), per_doc.column("doc")),
        "source": pc.take(batch.column("source"), per_doc.column("doc")),
        "term": per_doc.column("term"),
        "n": per_doc.column("term_count").cast(pa.int64()),
        "docs": pa.array(np.ones(per_doc.num_rows, np.int64)),
    })
    marks = pa.table({"lang": batch.column("lang"), "source": batch.column("source")}).group_by(["lang", "source"]).aggregate([])
    empty = pa.table({
        "lang": marks.column("lang"), "source": marks.column("source"),
        "term": pa.array([""] * marks.num_rows, pa.string()),
        "n": pa.array(np.zeros(marks.num_rows, np.int64)), "docs": pa.array(np.zeros(marks.num_rows, np.int64)),
    })
    return _combined([rows, empty])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``SLICE_BYTES`` of text (a longer text is a part of its own)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _index(block_terms: int):
    """Block postings of a task's documents, spilled as term-sorted runs when a block holds ``block_terms`` keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = [], 0
        for batch in batches:
            for part in _slices(batch):
                block.append(_postings(part))
                keys += block[-1].num_rows
                if keys >= block_terms:
                    merged = _combined(block)
                    if merged.num_rows >= block_terms // 2:
                        yield from merged.sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).to_batches()
                        block, keys = [], 0
                    else:
                        block, keys = [merged], merged.num_rows
        if block:
            merged = _combined(block)
            yield from merged.sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).to_batches()

    return run


def _merged(table: pa.Table) -> pa.Table:
    summed = table.group_by(["lang", "term", "source"]).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns(["lang", "term", "source", "n", "docs"]).select(["lang", "source", "term", "n", "docs"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up adjacent equal keys of a sorted stream; the rows of the last key wait for the next batch."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
        if table.num_rows == 0:
            continue
        # Equal keys are adjacent, so the rows of the last key are the end of the batch.
        last = [pc.equal(table.column(c), table.column(c)[-1]) for c in ("lang", "term", "source")]
        cut = table.num_rows - pc.sum(pc.and_(pc.and_(last[0], last[1]), last[2])).as_py()
        if cut:
            yield from _merged(table.slice(0, cut)).to_batches()
        carry = table.slice(cut)
    if carry is not None and carry.num_rows:
        yield from _merged(carry).to_batches()


def frequencies(docs: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group, by index and merge."""
    read = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.col("text").cast("string").alias("text"),
    )
    runs = read.mapInArrow(_index(block_terms), _RUN)
    shards = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(_merge, _RUN)


def _p(count, total, v) -> F.Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(38,0)) * ({count} + {ALPHA})) div ({total} + {ALPHA} * {v})")


def audit(
    docs: DataFrame, ws: Workspace, min_docs: int = MIN_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank: see the module docstring. The frequencies are written to ``ws``."""
    freq, _ = ws.save(frequencies(docs, block_terms), "frequencies")
    kept = freq.filter(F.col("term") != "").groupBy("lang", "term").agg(F.sum("docs").alias("df")).filter(F.col("df") >= min_docs).drop("df")
    present = freq.join(kept, ["lang", "term"]).select("lang", "source", "term", "n")
    vocab = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = (
        freq.filter(F.col("term") == "")
        .select("lang", "source")
        .distinct()
        .join(present.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(vocab, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
        .withColumn("p0", F.when(F.col("v") > 0, _p("0", "total", "v")))
    )
    # The groups are few, but their number is measured before they are broadcast.
    size = groups.agg(F.sum(F.length("source") + F.length("lang") + 48)).first()[0] or 0
    small = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)
    langs = groups.groupBy("lang", "v").agg(F.sum("total").alias("lang_total"))
    valued = present.join(small(groups.select("lang", "source", "total", "v")), ["lang", "source"]).withColumn(
        "p", _p("n", "total", "v")
    )

    # Part pair: per (lang, term) the present sources, each streaming its corrections to every other source.
    lists = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("sources"))
    per_term = valued.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p")).alias("here"))
    per_term = per_term.join(small(lists), "lang")
    # Every source of the lang with its value of the term, built once per term (and read twice, so never inlined).
    aligned = per_term.withColumn("hm", F.map_from_entries("here")).select(
        "lang",
        F.expr(
            """transform(sources, y -> named_struct('source', y.source, 'p0', y.p0,
                 'q', coalesce(hm[y.source], y.p0), 'present', hm[y.source] is not null))"""
        ).alias("all"),
    )
    corrections = aligned.select(
        "lang",
        F.explode(
            F.expr(
                """flatten(transform(filter(all, x -> x.present), x -> transform(
                     filter(all, y -> y.source != x.source and (not y.present or y.source > x.source)),
                     y -> named_struct('a', least(x.source, y.source), 'b', greatest(x.source, y.source),
                                       'c', abs(x.q - y.q) - abs(x.p0 - y.p0)))))"""
            )
        ).alias("k"),
    ).groupBy("lang", F.col("k.a").alias("a"), F.col("k.b").alias("b")).agg(F.sum("k.c").alias("c"))
    pairs = (
        groups.alias("x")
        .join(groups.alias("y"), (F.col("x.lang") == F.col("y.lang")) & (F.col("x.source") < F.col("y.source")))
        .select(
            F.col("x.lang").alias("lang"),
            F.col("x.source").alias("a"),
            F.col("y.source").alias("b"),
            F.coalesce(F.col("x.v") * F.abs(F.col("x.p0") - F.col("y.p0")), F.lit(0)).alias("base"),
        )
        .join(corrections, ["lang", "a", "b"], "left")
        .select("lang", "a", "b", (F.col("base") + F.coalesce("c", F.lit(0))).alias("value"))
    )
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    order = [F.col("value").desc(), F.col("item").cast("binary").asc()]
    pair_part = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))

    # Part term: the group's value against the lang's, ranked in two steps.
    lang_counts = present.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    above = (
        valued.join(lang_counts, ["lang", "term"])
        .join(small(langs.select("lang", "lang_total")), "lang")
        .select("lang", "source", F.col("term").alias("item"), (F.col("p") - _p("lang_n", "lang_total", "v")).alias("value"))
        .filter(F.col("value") > 0)
    )
    shard = F.pmod(F.xxhash64("item"), F.lit(RANK_SHARDS))
    first = above.withColumn("r", F.row_number().over(Window.partitionBy("lang", "source", shard).orderBy(*order)))
    term_part = (
        first.filter(F.col("r") <= top)
        .drop("r")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
        .filter(F.col("rank") <= top)
    )
    parts = pair_part.withColumn("part", F.lit("pair")).unionByName(term_part.withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int"))
