"""Substring dedup: remove every word covered by a 50-word window that already stands in a document of smaller doc_id.

Method: level-wise doubling, with two levels grouped across documents.

* A window of length ``L`` at word ``p`` has a 128-bit hash built from its two halves of length ``h = ceil(L/2)`` at
  ``p`` and ``p + L - h`` (overlapping when ``L`` is odd); one word's hash is its xxhash64 in two lanes. The hash
  depends only on the word sequence, so equal windows have equal hashes wherever they stand. The hashes are doubled
  inside each document, in Arrow batches, without any exchange.
* Exact copies of a text are one text from the start, with the smallest doc_id: all windows of the others stand there.
* At ``BASE`` words only *marks* are grouped across documents: of all base windows inside a 50-word window, the first
  with the smallest hash. The choice depends only on the words of the window, so a window that stands in two documents
  has the same mark in both. A mark is *repeated* if its hash stands in two documents of different doc_id; windows whose
  mark is not repeated stand in one document only and are dropped for good.
* At 50 words the hashes of what is left are grouped: a window whose hash has a smaller doc_id than its own document's
  is removed with all its words. Covered words are the union of those windows; the kept words are the others.

Each level groups hashes (partial aggregation before the exchange), writes the groups, and joins them back to the
positions: hashes standing more often than ``hot_at`` (at most ``HOT_KEYS`` of them, a proven bound) are broadcast,
so a passage shared by a third of the corpus is no single task, and the others are joined by a plain exchange.
Only texts with a repeated mark are read again as texts; all others keep their words, digested in the first pass.

Words are runs of ``[^\\x20\\x09-\\x0D]`` as they stand. Edge cases: null text has no words; a document of fewer than 50
words has no window and keeps all; repeated rows with one doc_id do not remove each other (neither is smaller), but
both lose what an earlier document holds; windows repeated inside one document remove nothing; null doc_id rows take no
part (keep everything, remove nothing from others); very long texts are worked on as arrays of one row and positions
of many; an empty table gives no rows; only doc_id and text are read, so other columns cannot clash.
Output per input row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space, UTF-8, lowercase hex).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namefold.workspace import Workspace

WINDOW = 50
BASE = 13  # length of the first windows that are grouped across documents
HOT_KEYS = 1 << 16  # hashes broadcast at most; a hash is hot if it stands more than total / HOT_KEYS times
HOT_MIN = 1 << 10  # and more than this
OUT_ROWS = 1 << 16  # rows of windows handed on at once
_SEEDS = (42, 0x2545F491)  # of the two hash lanes; fixed values
_HALVES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0x165667B19E3779F9, 0xD6E8FEB86659FD93))  # odd constants
_TEXT = ["ka", "kb"]  # two hashes of a text that name it

Hashes = tuple[np.ndarray, np.ndarray]


def chain(target: int = WINDOW) -> list[int]:
    """Window lengths from one word up to ``target``, each made of two halves of the one before."""
    out = [target]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _doubled(hashes: Hashes, length: int, half: int) -> Hashes:
    """Hashes of all windows of ``length`` words from those of ``half`` words; each lane takes in both lanes."""
    n, shift = len(hashes[0]) + half - length, length - half
    a, b = hashes
    out = []
    for k, (one, two) in enumerate(_HALVES):
        x, y = (a, b) if k == 0 else (b, a)
        left = _mixed(x[:n] * np.uint64(one) + y[:n])
        out.append(_mixed(left * np.uint64(two) + _mixed(x[shift:] + np.uint64(length)) + y[shift:] * np.uint64(one)))
    return out[0], out[1]


def _word_hashes(words: list[bytes]) -> Hashes:
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    lanes = (partial(xxhash.xxh64_intdigest, seed=s) for s in _SEEDS)
    a, b = (np.fromiter(map(f, place), np.uint64, len(place))[at] for f in lanes)
    return a, b


def _upto(hashes: Hashes, half: int, target: int, window: int) -> Hashes:
    """Hashes of all windows of ``target`` words from those of ``half`` words, both in the chain of ``window``."""
    for length in chain(window):
        if half < length <= target:
            hashes, half = _doubled(hashes, length, half), length
    return hashes


def _marks(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each ``span`` consecutive hashes, the place of the first smallest one."""
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.arange(len(hashes))  # equal hashes ascend by place, so the first smallest has the smallest rank
    best, width = rank, 1
    while width < span:
        step = min(width, span - width)
        best = np.minimum(best[: len(best) - step], best[step:])
        width += step
    return order[best]


def _base(window: int, base: int) -> int:
    return next(x for x in chain(window) if x >= min(base, window))


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # bytes.split knows ASCII white space only, x09 to x0D and the blank


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _rows(docs: DataFrame, window: int, base: int) -> DataFrame:
    """Per row: doc_id, ka, kb, n, digest of all words, hashes and places of its marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = _base(window, base)
        for batch in batches:
            n, digests, marks, places = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = _split(text.as_py())
                n.append(len(words))
                digests.append(_digest(words))
                if doc_id is None or len(words) < window:
                    marks.append(None)
                    places.append(None)
                    continue
                hashes = _upto(_word_hashes(words), 1, length, window)[0]
                at = np.unique(_marks(hashes, window - length + 1))
                marks.append(hashes[at].view(np.int64))
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *_TEXT)), pa.array(n, pa.int32()), pa.array(digests, pa.string()),
                 pa.array(marks, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", *_TEXT, "n", "digest", "marks", "places"],
            )

    return docs.mapInArrow(run, "doc_id long, ka long, kb long, n int, digest string, marks array<long>, places array<int>")


def _windows(opened: DataFrame, window: int, base: int) -> DataFrame:
    """(rid, doc_id, pos, a, b) of the windows whose mark is one of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = _base(window, base)
        found: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "pos", "a", "b"])

        for batch in batches:
            size = 0
            ids = (batch.column(c).to_pylist() for c in ("rid", "doc_id"))
            for rid, doc_id, text, places in zip(*ids, batch.column("text").cast(pa.binary()), batch.column("places")):
                hashes = _upto(_word_hashes(_split(text.as_py())), 1, length, window)
                # The marks are those of the first pass: both double the same words.
                pos = np.flatnonzero(np.isin(_marks(hashes[0], window - length + 1), places.values.to_numpy()))
                a, b = (x[pos].view(np.int64) for x in _upto(hashes, length, window, window))
                found.append((np.full(len(pos), rid), np.full(len(pos), doc_id), pos.astype(np.int32), a, b))
                size += len(pos)
                if size > OUT_ROWS:
                    yield out()
                    size = 0
            if found:
                yield out()

    return opened.select("rid", "doc_id", "text", "places").mapInArrow(run, "rid long, doc_id long, pos int, a long, b long")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """(rid, n_removed, kept) of texts without the words of the windows at ``starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            for text, starts in zip(batch.column("text").cast(pa.binary()), batch.column("starts")):
                words = _split(text.as_py())
                at = starts.values.to_numpy()
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                removed.append(len(words) - len(kept))
                digests.append(_digest([words[i] for i in kept]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], ["rid", "n_removed", "kept"]
            )

    return texts.select("rid", "text", "starts").mapInArrow(run, "rid long, n_removed long, kept string")


def _attach(positions: DataFrame, keys: list[str], ws: Workspace, name: str) -> DataFrame:
    """Positions whose hash stands in two documents, with the smallest and largest doc_id of the hash.

    Hot hashes are joined by broadcast, the rest by exchange."""
    groups = positions.groupBy(*keys).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("times")
    )
    # Only hashes in two documents matter at any level: a removed window's hash has a smaller doc_id than its own.
    groups, seen = ws.save(groups.filter(F.col("first") < F.col("last")), name, total=F.sum("times"))
    hot_at = max(HOT_MIN, (seen["total"] or 0) // HOT_KEYS)
    hot = groups.filter(F.col("times") > hot_at).drop("times", "last")  # at most total / hot_at <= HOT_KEYS rows
    cold = groups.filter(F.col("times") <= hot_at).drop("times", "last")
    met = positions.join(F.broadcast(hot), keys, "left")
    return met.filter(F.col("first").isNotNull()).unionByName(
        met.filter(F.col("first").isNull()).drop("first").join(cold, keys)
    )


def dedup(docs: DataFrame, ws: Workspace, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per input row; see the module docstring."""
    names = [F.xxhash64("text").alias("ka"), F.xxhash64(F.lit(_SEEDS[1]), "text").alias("kb")]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *names)
    rows, _ = ws.save(_rows(read, window, base), "rows")
    # One row of each text, with the smallest doc_id that has it; a text's marks are the same in every row.
    own = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") >= window))
    texts = own.groupBy(*_TEXT).agg(F.min("doc_id").alias("doc_id"), F.min("marks").alias("marks"), F.min("places").alias("places"))
    texts, _ = ws.save(texts.withColumn("rid", F.monotonically_increasing_id()), "texts")
    marks = texts.select("rid", "doc_id", F.explode(F.arrays_zip("marks", "places")).alias("x"))
    marks = marks.select("rid", "doc_id", F.col("x.places").alias("pos"), F.col("x.marks").alias("a"))
    met = _attach(marks, ["a"], ws, "marks")
    opened = texts.select("rid", "doc_id", *_TEXT).join(met.groupBy("rid").agg(F.collect_list("pos").alias("places")), "rid")
    opened, _ = ws.save(opened, "opened")
    # Repeated rows of one doc_id and text give the same windows again, so one of them goes on; the join's key brings
    # them together, so that texts are not exchanged again.
    key = ["doc_id", *_TEXT]
    whole, _ = ws.save(read.join(opened, key).dropDuplicates(key).select("rid", "doc_id", "text", "places"), "whole")
    windows, _ = ws.save(_windows(whole, window, base), "windows")
    removed = _attach(windows, ["a", "b"], ws, "groups").filter(F.col("doc_id") > F.col("first"))
    starts = removed.groupBy("rid").agg(F.collect_list("pos").alias("starts"))
    cut = _cut(whole.select("rid", "text").join(starts, "rid"), window)
    named = texts.select(*_TEXT, F.col("doc_id").alias("earliest"), "rid").join(cut, "rid", "left")
    named, _ = ws.save(named.drop("rid"), "named")
    out = rows.select("doc_id", *_TEXT, "n", "digest").join(named, _TEXT, "left")
    n = F.col("n").cast("long")
    # Rows without a doc_id keep all, also where another row has their text.
    part = F.col("doc_id").isNotNull() & F.col("earliest").isNotNull()
    copy = part & (F.col("doc_id") > F.col("earliest"))
    return out.select(
        "doc_id",
        n.alias("n_words"),
        F.when(copy, n).when(part, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, _digest([])).when(part, F.coalesce("kept", "digest")).otherwise(F.col("digest")).alias("kept_sha256"),
    )
