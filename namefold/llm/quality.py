"""Quality: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A document is the average of learned vectors of its words, its pairs of neighbouring words and the character n-grams
of its words, hashed to ``BUCKETS`` rows, with a blank as the mark of a word's start and end; a softmax over two classes follows. Documents are
shown one at a time, in a new order every epoch, with a falling learning rate.

Both layers are linear, so for scoring the model folds to one number per bucket: the score is the sigmoid of the mean
of the numbers of a text's features. Whole texts are scored, in Arrow batches: features are hashed for many
documents at once with array operations over their code points.

Training takes a documented, bounded sample: at most ``per_class`` documents of each label, chosen by a hash of
doc_id, among the rows that the caller allows. The executors count their features; the driver gets counts only.

Nulls: a null or blank text has no features and gets the score of the bias; labels without an id, document or value
are not used. Repeated rows are scored alike. Other columns are never looked at. Without labels of both kinds every
score is 0.5. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 1500
BUCKETS = 1 << 18
DIMENSIONS = 8
ORDERS = (3, 4, 5)
STEPS = 18_000  # documents shown, whatever the size of the sample
RATE = 0.5
CUTOFF = 0.7
PIECE = 400_000  # code points hashed at once
LONGEST = 4096  # a place in a word beyond this counts like the one so many before

_POWERS = np.cumprod(np.full(LONGEST, 0x01000193, np.uint32), dtype=np.uint32)


@dataclass(frozen=True)
class Quality:
    """``table``: one number per bucket; the score of a text is sigmoid(bias + mean over its features)."""

    table: np.ndarray
    bias: float


def features(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashed features of the texts, in pieces: number of the first text of the piece, texts, buckets.

    Texts longer than a piece are hashed alone, whole.
    """
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 2
        if size > PIECE or i + 1 == len(texts):
            owner, bucket = _hashed(texts[first : i + 1])
            yield first, owner + first, bucket
            first, size = i + 1, 0


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    # A blank on each side of every text.
    joined = " " + "  ".join(texts) + " "
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (c == 32) | ((c >= 9) & (c <= 13))
    c = np.where(blank, np.uint32(32), c)
    ends = np.cumsum([len(t) + 2 for t in texts])
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends, prepend=0))
    shift = np.uint32(32 - (BUCKETS - 1).bit_length())
    owners, buckets = [], []
    start = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(start):
        place = np.arange(len(c)) - np.repeat(np.concatenate(([0], start)), np.diff(np.concatenate(([0], start, [len(c)]))))
        letters = np.where(blank, np.uint32(0), c * _POWERS[place % LONGEST])
        word = np.add.reduceat(letters, start, dtype=np.uint32)
        owners.append(text_of[start])
        buckets.append(_spread(word, 1) >> shift)
        # Pairs of neighbouring words by their difference: all repeated words share one feature.
        pair = np.flatnonzero(text_of[start[1:]] == text_of[start[:-1]])
        owners.append(text_of[start[pair]])
        buckets.append(_spread(word[pair + 1] ^ word[pair], 2) >> shift)
    h = c * np.uint32(0x9E3779B1)
    inner = np.zeros(len(c), bool)  # whether a blank lies strictly inside the n-gram that starts here
    for n in range(2, max(ORDERS) + 1):
        count = len(c) - n + 1
        if count <= 0:
            break
        h = (h[:count] ^ c[n - 1 :]) * np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(15)
        inner = inner[:count] | blank[n - 2 : n - 2 + count] if n > 2 else inner[:count]
        if n in ORDERS:
            # The blank behind a word may be one of two between texts; both belong to the text they follow or start.
            kept = np.flatnonzero(~inner)
            owners.append(text_of[kept])
            buckets.append(_spread(h[kept], n) >> shift)
    return np.concatenate(owners or [np.zeros(0, np.int32)]), np.concatenate(buckets or [np.zeros(0, np.uint32)])


def _spread(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint32(kind * 0x01010101)) * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(16)
    return h * np.uint32(0x27D4EB2F)


def scores(texts: list[str], model: Quality) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for _, owner, bucket in features(texts):
        total += np.bincount(owner, weights=model.table[bucket], minlength=len(texts))
        count += np.bincount(owner, minlength=len(texts))
    z = model.bias + total / np.maximum(count, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> DataFrame:
    """``(doc_id, text, label)`` of a bounded number of labelled documents, by a hash of their ids."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed)
    known = known.select("doc_id", F.col(label).cast("int").alias("label"), F.xxhash64("doc_id", F.lit(3)).alias("draw"))
    parts = [known.filter(F.col("label") == y).orderBy("draw", "doc_id").limit(per_class) for y in (0, 1)]
    # At most twice per_class rows of three numbers.
    chosen = F.broadcast(parts[0].unionByName(parts[1]).drop("draw"))
    return docs.select("doc_id", "text").join(chosen, "doc_id")


def feature_counts(labelled: DataFrame) -> list:
    """``(doc_id, label, buckets, counts)`` of the sampled documents, as little-endian numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = [b for _, _, b in features([text or ""])]
                rows.append(np.unique(np.concatenate(found), return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([b.astype("<u4").tobytes() for b, _ in rows], pa.binary()),
                    pa.array([n.astype("<u4").tobytes() for _, n in rows], pa.binary()),
                ],
                ["doc_id", "label", "buckets", "counts"],
            )

    found = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), "label", "text")
    rows = found.mapInArrow(run, "doc_id bigint, label int, buckets binary, counts binary").collect()
    return sorted(rows, key=lambda r: (r.doc_id, r.label))


def train(rows: list, steps: int = STEPS, rate: float = RATE, seed: int = 1) -> Quality:
    """Stochastic gradient descent over ``(label, buckets, counts)``."""
    labels = np.array([r.label for r in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        return Quality(np.zeros(BUCKETS, np.float32), 0.0)
    shown = []
    for r in rows:
        ids, n = np.frombuffer(r.buckets, "<u4").astype(np.int64), np.frombuffer(r.counts, "<u4").astype(np.float32)
        shown.append((ids, n / max(1.0, float(n.sum()))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = rng.uniform(-0.1, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weight = len(rows) / (2.0 * np.bincount(labels, minlength=2))
    done = 0
    while done < steps:
        for i in rng.permutation(len(rows)).tolist()[: steps - done]:
            ids, share = shown[i]
            pace = rate * (1 - done / steps)
            done += 1
            mean = share @ vectors[ids]
            z = mean @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            p *= np.float32(weight[labels[i]])
            back = output @ p
            output -= np.float32(pace) * np.outer(mean, p)
            bias -= np.float32(pace * 0.1) * p
            # A step of fixed length along the document's mean: long documents have shares too small to move.
            step = share / np.float32(np.sqrt(share @ share))
            vectors[ids] -= np.float32(pace) * step[:, None] * back[None, :]
    folded = vectors @ (output[:, 1] - output[:, 0])
    return Quality(folded.astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, per_class: int = PER_CLASS) -> Quality:
    """Learn ``labels.quality`` from the labelled documents whose doc_id meets ``allowed``."""
    return train(feature_counts(sample(docs, labels, "quality", F.lit(True) if allowed is None else allowed, per_class)))


def held_out(doc_id: Column) -> Column:
    """The documents kept for measuring: a quarter, by the checksum of the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predicted(docs: DataFrame, model: Quality) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores([t or "" for t in texts], model))

    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), score("text").alias("score"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= CUTOFF, 1).otherwise(0).alias("predicted"),
    )
