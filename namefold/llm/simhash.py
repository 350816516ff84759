"""SimHash near-duplicate detection by bit-sliced comparison.

1. Every whole text gets a fingerprint: bit i is set if it is set in over half of its shingles' hashes.
2. Equal fingerprints become one node, aggregated before the exchange; a group of exact copies of any size costs one
   row per task from here on.
3. Nodes meet in buckets whose key is part of the fingerprint. Hot buckets are dealt again by more of the
   fingerprint (``EXACT``) or cut into blocks (``NEAR``), so no key gathers an unbounded group. Inside a bucket, ``bitslice`` compares the members and
   emits a spanning forest of the links, never all pairs.
4. Links of all buckets are joined to components, and every document gets the smallest doc_id of its component.

``EXACT`` finds every link: with at most 2 differing bits in four blocks of 16, two blocks agree, so the six pairs of
blocks are the keys; in a hot bucket the other 32 bits are cut into four blocks of 8, of which again two agree. A
bucket then holds at most 2**16 nodes, whatever the input.

``NEAR`` links texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8. Candidates come from
256-bit fingerprints of the sets: 28 bands of 9 bits are the keys, and the reach is 72 bits. A pair at 0.8 differs in
about 39 bits (calculated: it shares a band with 99.9 percent, and lies within reach but for less than one in 100,000).
Candidates only join nodes to families; inside a family, every link is decided by the shingle sets. A bucket of over
``BLOCK`` nodes and a family of over ``SET_BLOCK`` shingles are cut into blocks, and every pair of blocks is a group of its
own, so all pairs still meet.

Nulls: a null or blank text has fingerprint zero and is linked like any other; a document without an id takes part,
but the smallest id is taken of the others (null if there is none). Fewer words than a shingle: the whole sequence
is one shingle. Repeated rows fall together. Other columns are not needed. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namefold.llm import bitslice
from namefold.llm.words import spaced_words
from namefold.operators.components import connected_components
from namefold.workspace import Workspace

HOT = 4096
BLOCK = 1 << 15  # nodes of a block of a hot bucket
SETS = 256  # texts whose shingles are held at once
SIMILAR = (4, 5)  # Jaccard similarity of near copies, as a fraction
SET_BLOCK = 1 << 21  # shingles of a block of a large family of candidates
SEED = 42
CHUNK = 1 << 14  # shingles counted at once
# Odd constants that turn one 64-bit hash into further ones. Fixed values.
_MORE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

Piece = tuple[int, int, int]  # word of the fingerprint, lowest bit, number of bits


@dataclass(frozen=True)
class SimHash:
    shingle: int  # words
    words: int  # 64-bit words of a fingerprint
    radius: int  # of EXACT, links are within it; of NEAR, it is the mean distance of a pair a little below ``SIMILAR``
    reach: int  # what is compared is linked, or with ``confirmed`` a candidate, up to this distance
    keys: tuple[tuple[Piece, ...], ...]  # the pieces that make each bucket key
    again: tuple[tuple[tuple[Piece, ...], ...], ...]  # for each key, the keys that deal its hot buckets again, or none
    confirmed: bool  # candidates are linked if the Jaccard similarity of their shingle sets is at least ``SIMILAR``


def _exact() -> SimHash:
    blocks = [(0, 16 * i, 16) for i in range(4)]
    keys, again = [], []
    for i in range(4):
        for j in range(i + 1, 4):
            keys.append((blocks[i], blocks[j]))
            rest = [(0, 16 * k + 8 * half, 8) for k in range(4) if k not in (i, j) for half in (0, 1)]
            again.append(tuple((rest[a], rest[b]) for a in range(4) for b in range(a + 1, 4)))
    return SimHash(3, 1, 2, 2, tuple(keys), tuple(again), False)


def _near() -> SimHash:
    bands = [((w, 9 * i, 9),) for w in range(4) for i in range(7)]
    return SimHash(5, 4, 44, 72, tuple(bands), (), True)


EXACT, NEAR = _exact(), _near()


def _mixed(h: np.ndarray, factor: int) -> np.ndarray:
    h = h * np.uint64(factor)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    words = spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    if len(words) <= k:
        return np.array([digest(b" ".join(words))], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
    return np.fromiter(map(digest, shingles), np.uint64, len(words) - k + 1)


def fingerprint(text: bytes, k: int, n_words: int) -> list[int]:
    """Unsigned 64-bit words; the first is over the plain hashes, the others over mixed ones."""
    return _majorities(shingle_hashes(text, k), n_words)


def _majorities(hashes: np.ndarray, n_words: int) -> list[int]:
    out = []
    for w in range(n_words):
        count = np.zeros(64, np.int64)
        for a in range(0, len(hashes), CHUNK):
            part = hashes[a : a + CHUNK]
            part = np.ascontiguousarray(_mixed(part, _MORE[w]) if w else part)
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
        set_bits = np.packbits(2 * count > len(hashes), bitorder="little")
        out.append(int.from_bytes(set_bits.tobytes(), "little"))
    return out


def fingerprints(docs: DataFrame, setting: SimHash, *carried: str) -> DataFrame:
    """``doc_id``, the columns ``carried``, and the fingerprint as ``f0``, ``f1``, ... per row of ``docs``.

    With ``confirmed``, shingles count once, and a last number tells apart different sets of one fingerprint.
    """

    def numbers(text: bytes) -> list[int]:
        if not setting.confirmed:
            return fingerprint(text, setting.shingle, setting.words)
        shingles = np.unique(shingle_hashes(text, setting.shingle))
        return [*_majorities(shingles, setting.words), xxhash.xxh64_intdigest(shingles.tobytes(), SEED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [numbers(t.as_py() or b"") for t in texts]
            table = np.array(found, np.uint64).reshape(-1, len(prints)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(table[:, w]) for w in range(len(prints)))], columns
            )

    names = ["doc_id", *carried]
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *carried, "text")
    prints = [f"f{w}" for w in range(setting.words + setting.confirmed)]
    columns = [*names, *prints]
    kinds = dict(chosen.dtypes) | {f: "bigint" for f in prints}
    return chosen.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def _key(number: int, pieces: tuple[Piece, ...]) -> Column:
    """The number of the key above the pieces."""
    key, width = F.lit(number).cast("bigint"), 0
    for word, low, bits in pieces:
        piece = F.shiftrightunsigned(f"f{word}", low).bitwiseAND(F.lit((1 << bits) - 1))
        key = F.shiftleft(key, bits).bitwiseOR(piece)
        width += bits
    return key


def _compare(setting: SimHash, keys: list[str], by_sets: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table, last: bool) -> tuple[list, list, pa.Table | None]:
            """Links of all complete groups; the rows of the last group, unless it is complete."""
            n = table.num_rows
            change = np.zeros(n, bool)
            for k in keys:
                values = table.column(k).to_numpy()
                change[1:] |= values[1:] != values[:-1]
            starts = np.concatenate(([0], np.flatnonzero(change), [n]))
            kept = None
            if not last:
                kept = table.slice(int(starts[-2]))
                starts = starts[:-1]
            ids = table.column("id").to_numpy()
            words = np.stack([table.column(f"f{w}").to_numpy() for w in range(setting.words)], axis=1).view(np.uint64)
            sets = table.column("shingles").combine_chunks() if by_sets else None

            def similar(i: int, j: int) -> bool:
                x, y = (sets[int(k)].values.to_numpy() for k in (i, j))
                # The sizes alone bound the similarity.
                if SIMILAR[1] * min(len(x), len(y)) < SIMILAR[0] * max(len(x), len(y)):
                    return False
                both = len(np.intersect1d(x, y, assume_unique=True))
                return SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both)

            u, v = [], []
            for g in np.flatnonzero(np.diff(starts) > 1).tolist():
                a, b = int(starts[g]), int(starts[g + 1])
                members = np.arange(a, b) if setting.again else a + np.flatnonzero(bitslice.paired(words[a:b], setting.reach))
                confirm = (lambda i, j: similar(members[i], members[j])) if by_sets else None
                for i, j in bitslice.links(words[members], setting.reach, confirm) if len(members) else ():
                    x, y = int(ids[members[i]]), int(ids[members[j]])
                    u.append(max(x, y))
                    v.append(min(x, y))
            return u, v, kept

        def out(u: list, v: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        def same(first: pa.Table, last: pa.Table) -> bool:
            return all(first.column(k)[0] == last.column(k)[-1] for k in keys)

        waiting: list[pa.Table] = []  # rows of the group that is not complete
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            waiting.append(table)
            if same(waiting[0], table):
                continue
            u, v, rest = links(pa.concat_tables(waiting).combine_chunks(), last=False)
            waiting = [rest]
            yield out(u, v)
        if waiting:
            u, v, _ = links(pa.concat_tables(waiting).combine_chunks(), last=True)
            yield out(u, v)

    return run


def _block_pairs(item: Column, blocks: Column) -> Column:
    """Numbers of the pairs of blocks that an item takes part in, so that any two items of a group meet in one."""
    own = F.pmod(F.xxhash64(item), blocks)
    return F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), lambda c: F.least(own, c) * blocks + F.greatest(own, c))


def placed(nodes: DataFrame, setting: SimHash, ws: Workspace, hot: int | None = None) -> DataFrame:
    """Nodes with the groups ``(key, part)`` in which they are compared, none of them unbounded."""
    prints = [f"f{w}" for w in range(setting.words)]
    hot = hot or (HOT if setting.again else BLOCK)
    keyed = nodes.select("id", *prints, F.explode(F.array(*(_key(i, k) for i, k in enumerate(setting.keys)))).alias("key"))
    # At most one in ``hot`` rows is the key of a hot bucket; written, so that Spark knows its size.
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
    crowded, _ = ws.save(sizes, "crowded")
    keyed = keyed.join(crowded, "key", "left")
    dealt = F.when(F.col("n").isNull(), F.array(F.lit(-1).cast("bigint")))
    if setting.again:
        width = [sum(p[2] for p in k) for k in setting.keys]
        number = F.shiftrightunsigned("key", width[0])
        for i, again in enumerate(setting.again):
            dealt = dealt.when(number == i, F.array(*(_key(j, k) for j, k in enumerate(again))))
    else:
        dealt = dealt.otherwise(_block_pairs(F.col("id"), F.ceil(F.col("n") / hot)))
    return keyed.select("id", *prints, "key", F.explode(dealt).alias("part"))


def near_edges(nodes: DataFrame, setting: SimHash, ws: Workspace, hot: int | None = None) -> DataFrame:
    """Links ``(u, v)``, u > v, between nodes ``(id, f0, ...)`` that connect what shares a key and lies within the radius."""
    groups = placed(nodes, setting, ws, hot).repartition("key", "part").sortWithinPartitions("key", "part")
    edges = groups.mapInArrow(_compare(setting, ["key", "part"]), "u bigint, v bigint")
    return ws.save(edges.distinct(), "links")[0]


def _shingle_sets(setting: SimHash, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for a in range(0, batch.num_rows, SETS):
                part = batch.slice(a, SETS)
                sets = [np.unique(shingle_hashes(t.as_py() or b"", setting.shingle)).view(np.int64) for t in texts.slice(a, SETS)]
                lists = pa.array(sets, pa.list_(pa.int64()))
                sizes = pa.array([len(x) for x in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), sizes, lists], [*columns, "size", "shingles"])

    return run


def confirmed_edges(
    docs: DataFrame, nodes: DataFrame, candidates: DataFrame, setting: SimHash, ws: Workspace, size: int | None = None
) -> DataFrame:
    """Links between nodes whose shingle sets have at least the similarity ``SIMILAR``.

    ``candidates`` connect the nodes to families outside of which no node has a link. Inside a family, pairs are checked
    by the sets themselves until they are connected; a family of over ``size`` shingles is cut into blocks.
    """
    prints = [f"f{w}" for w in range(setting.words)]
    with ws.scratch() as work:
        linked = connected_components(candidates, work)
        family = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
        members = nodes.join(family.select(F.col("node").alias("id"), F.col("root").alias("key")), "id")
        members, _ = work.save(members.select("id", *prints, "key", "sample"), "members")
        # One row of each text; equal rows are reduced before the exchange.
        texts = docs.select(F.xxhash64("text").alias("sample"), "text")
        texts = texts.join(members.select("sample"), "sample", "left_semi").groupBy("sample").agg(F.first("text").alias("text"))
        texts, _ = work.save(texts, "texts")
        columns = ["id", *prints, "key"]
        kinds = ", ".join(f"{c} bigint" for c in [*columns, "size"])
        sets = members.join(texts, "sample").select(*columns, "text")
        sets, _ = work.save(sets.mapInArrow(_shingle_sets(setting, columns), f"{kinds}, shingles array<bigint>"), "sets")
        work.discard(texts)
        blocks = sets.groupBy("key").agg(F.ceil(F.sum("size") / (size or SET_BLOCK)).alias("blocks")).filter(F.col("blocks") > 1)
        blocks, _ = work.save(blocks, "large")
        part = F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("bigint"))).otherwise(_block_pairs(F.col("id"), F.col("blocks")))
        groups = sets.join(blocks, "key", "left").withColumn("part", F.explode(part)).drop("size", "blocks")
        groups = groups.repartition("key", "part").sortWithinPartitions("key", "part")
        edges = groups.mapInArrow(_compare(setting, ["key", "part"], by_sets=True), "u bigint, v bigint")
        return ws.save(edges.distinct(), "confirmed")[0]


def components(docs: DataFrame, setting: SimHash, ws: Workspace, *carried: str) -> DataFrame:
    """``doc_id``, the columns ``carried``, ``f0``, ... and ``component_id`` per row of ``docs``."""
    prints = [f"f{w}" for w in range(setting.words + setting.confirmed)]
    own = docs.withColumn("_sim_sample", F.xxhash64("text")) if setting.confirmed else docs
    rows, _ = ws.save(fingerprints(own, setting, *carried, *["_sim_sample"] * setting.confirmed), "fingerprints")
    sample = [F.min("_sim_sample").alias("sample")] * setting.confirmed
    nodes = rows.groupBy(*prints).agg(F.min("doc_id").alias("first"), *sample)
    nodes, _ = ws.save(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    edges = near_edges(nodes, setting, ws)
    if setting.confirmed:
        edges = confirmed_edges(docs, nodes, edges, setting, ws)
    linked = connected_components(edges, ws)
    rooted = nodes.join(linked.select(F.col("node").alias("id"), "root"), "id", "left")
    rooted, _ = ws.save(rooted.select(*prints, "first", F.coalesce("root", "id").alias("root")), "rooted")
    # Written, so that a large component's nodes can be split: a plain table is on either side of the join.
    lowest, _ = ws.save(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "lowest")
    groups, _ = ws.save(rooted.join(lowest, "root").select(*prints, "component_id", "root"), "groups")
    return rows.drop("_sim_sample").join(groups, prints, "left")


_ROW_KEY = ["_sim_none", "_sim_id", "_sim_text"]


def _row_key(rows: DataFrame) -> DataFrame:
    """Adds the doc_id without nulls, and whether it was one."""
    id_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))
    return rows.withColumn("_sim_none", F.col("doc_id").isNull()).withColumn("_sim_id", id_)


def keep_one(docs: DataFrame, setting: SimHash, ws: Workspace) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id, ties by a hash of the text."""
    own = docs.withColumn("_sim_text", F.xxhash64("text"))
    chosen = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_sim_text")
    # Only the rows to keep outlive this call; the tables that led to them, texts and shingles among them, go.
    with ws.scratch() as work:
        rows = components(own, setting, work, "_sim_text")
        kept = rows.groupBy("root").agg(F.min(chosen).alias("k"))
        kept, _ = ws.save(_row_key(kept.select("k.doc_id", "k._sim_text")).select(*_ROW_KEY), "kept")
    # Plain key columns: a join that deals the texts by them leaves nothing to exchange for the repeated rows.
    found = _row_key(own).join(kept, _ROW_KEY, "left_semi")
    return found.dropDuplicates(_ROW_KEY).select(*docs.columns)
