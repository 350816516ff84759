"""Toxicity: a cumulative-link ordinal regression from sparse word features to severity grades.

P(grade <= k) = sigmoid(threshold_k - weights . features): one weight per word, shared by all thresholds, which are
kept in ascending order. Features are log(1 + occurrences in 200 words) of the lower-cased words of the whole text and of
the words' beginnings. The model is trained
with numpy by accelerated proximal gradient descent. An L1 penalty above the noise of a gradient first leaves a few
words, which are then fitted alone, so a long clean text does not gather noise, and scoring looks up only those words.

Training takes a documented, bounded sample: at most ``per_class`` toxic and twice as many clean labelled documents,
chosen by a hash of doc_id. Their hashed features are counted on the executors; the driver gets numbers only.

Severity grades: ``grade_labels`` turns 0/1 labels into grades. Grade 0 is a clean document. A toxic document gets
grade 1, 2 or 3 by the third in which its share of marked features falls, where a feature is marked if its share of
toxic documents is over ``LIFT`` times that of clean ones. With graded labels at hand, ``train`` takes them as they are.

Nulls: a null or empty text has no features and gets the base rate; labels without an id, document or value are not
used; a document with several labels is used once per label. Repeated rows are scored alike. Other columns are not
needed. Without any labelled documents of both kinds every severity is 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namefold.llm.words import plain_words

PER_CLASS = 1500
CACHE_WORDS = 200_000
PER_WORDS = 200
PREFIX = (4, 8)
SCREENED = 500  # features with the strongest pull at the start, which the L1 penalty chooses from
GRADES = 4
LIFT = 20.0
MIN_DOCUMENTS = 4  # of the sample that have a word
NOISE = 1.0  # the L1 penalty, in standard deviations of a gradient's noise at most
RIDGE = 1e-3
MIN_GAP = 0.1  # between thresholds, which stay in ascending order
STEPS = 300
REJECT_AT = 0.5  # P(grade > 0)


def features_of(word: bytes) -> list[int]:
    """Hashes of the word and of its beginnings of 4 to 8 bytes: inflected and compound forms share these."""
    starts = (word[:k] + b"*" for k in range(PREFIX[0], min(PREFIX[1], len(word) - 1) + 1))
    return [xxhash.xxh32_intdigest(f) for f in (word, *starts)]


@dataclass(frozen=True)
class Severity:
    """``weights``: hashed feature to weight; P(grade <= k) = sigmoid(thresholds[k] - score)."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """One row per score, one column per grade."""
        if not self.thresholds:
            return np.ones((len(scores), 1))
        below = _sigmoid(np.array(self.thresholds)[None, :] - np.asarray(scores, float)[:, None])
        edges = np.concatenate((np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))), axis=1)
        return np.diff(edges, axis=1)


class Scorer:
    """Scores texts; keeps the weighted features of the words it has met, up to ``CACHE_WORDS``."""

    def __init__(self, model: Severity):
        self.model = model
        self.known: dict[bytes, tuple[int, ...]] = {}

    def score(self, text: bytes | None) -> float:
        words, known, weights = plain_words(text or b""), self.known, self.model.weights
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = tuple(f for f in features_of(w) if f in weights)
        found = Counter(f for fs in filter(None, map(known.__getitem__, words)) for f in fs)
        return sum(weights[f] * float(np.log1p(PER_WORDS * c / len(words))) for f, c in sorted(found.items()))

    def probabilities(self, texts: list[bytes | None]) -> np.ndarray:
        return self.model.probabilities(np.array([self.score(t) for t in texts], float))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``(doc_id, text, label)`` of a bounded number of labelled documents, by a hash of their ids."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.select("doc_id", F.col(label).cast("int").alias("label"), F.xxhash64("doc_id", F.lit(7)).alias("draw"))
    one = known.filter("label = 1").orderBy("draw", "doc_id").limit(per_class)
    zero = known.filter("label = 0").orderBy("draw", "doc_id").limit(2 * per_class)
    # At most three times per_class rows of three numbers.
    chosen = F.broadcast(one.unionByName(zero).drop("draw"))
    return docs.select("doc_id", "text").join(chosen, "doc_id")


def feature_counts(labelled: DataFrame) -> list:
    """``(doc_id, label, n_words, features, counts)`` of the sampled documents, as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counted(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([f for _, f, _ in rows], pa.binary()),
                    pa.array([c for _, _, c in rows], pa.binary()),
                ],
                ["doc_id", "label", "n_words", "features", "counts"],
            )

    schema = "doc_id bigint, label int, n_words bigint, features binary, counts binary"
    found = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), "label", "text")
    return sorted(found.mapInArrow(run, schema).collect(), key=lambda r: (r.doc_id, r.label, r.n_words))


def counted(text: bytes) -> tuple[int, bytes, bytes]:
    """Words, hashed features and their counts."""
    words = Counter(plain_words(text))
    found: Counter = Counter()
    for w, c in words.items():
        for f in features_of(w):
            found[f] += c
    features, counts = np.array(list(found), "<u4"), np.array(list(found.values()), "<u4")
    return sum(words.values()), features.tobytes(), counts.tobytes()


@dataclass
class Matrix:
    """Sparse feature counts of the sample: parallel rows, columns and counts, one entry per document and feature."""

    names: np.ndarray
    doc: np.ndarray
    col: np.ndarray
    count: np.ndarray
    length: np.ndarray  # words of each document

    @property
    def value(self) -> np.ndarray:
        return np.log1p(PER_WORDS * self.count / self.length[self.doc])

    def columns(self, chosen: np.ndarray) -> "Matrix":
        number = np.full(len(self.names), -1, np.int32)
        number[chosen] = np.arange(len(chosen))
        col = number[self.col]
        kept = col >= 0
        return Matrix(self.names[chosen], self.doc[kept], col[kept], self.count[kept], self.length)

    def distinct(self) -> "Matrix":
        """One column of each set of equal ones, such as a word and the beginnings that only it has."""
        mark = np.random.default_rng(0).random(len(self.length))
        same = np.bincount(self.col, weights=self.count * mark[self.doc], minlength=len(self.names))
        return self.columns(np.sort(np.unique(np.round(same, 9), return_index=True)[1]))


def feature_matrix(rows: list) -> Matrix:
    """Counts of the features that at least ``MIN_DOCUMENTS`` documents have."""
    features = [np.frombuffer(r.features, "<u4") for r in rows]
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for f in features])
    every = np.concatenate(features or [np.zeros(0, "<u4")])
    count = np.concatenate([np.frombuffer(r.counts, "<u4") for r in rows] or [np.zeros(0, "<u4")])
    names, seen = np.unique(every, return_counts=True)
    names = names[seen >= MIN_DOCUMENTS]
    place = np.searchsorted(names, every).astype(np.int32)
    kept = place < len(names)
    kept[kept] = names[place[kept]] == every[kept]
    length = np.array([max(1, r.n_words) for r in rows], np.int64)
    return Matrix(names, doc[kept], place[kept], count[kept], length)


def grade_labels(rows: list, m: Matrix) -> np.ndarray:
    """Grades 0 to 3 of labelled documents, see above."""
    toxic = np.array([r.label for r in rows], bool)
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    of_toxic = np.bincount(m.col[toxic[m.doc]], minlength=len(m.names))
    of_clean = np.bincount(m.col[~toxic[m.doc]], minlength=len(m.names))
    marked = (of_toxic >= MIN_DOCUMENTS) & (of_toxic / n_toxic > LIFT * (of_clean + 1) / n_clean)
    share = np.bincount(m.doc, weights=m.count * marked[m.col], minlength=len(rows))
    share = share / m.length
    cuts = np.quantile(share[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    return np.where(toxic, 1 + (share > cuts[0]) + (share > cuts[1]), 0).astype(int)


def _steepness(doc: np.ndarray, col: np.ndarray, val: np.ndarray, n: int, m: int) -> float:
    """The largest eigenvalue of X'X / n by power iteration."""
    v, size = np.ones(m), 1.0
    for _ in range(20):
        v = np.bincount(col, weights=val * np.bincount(doc, weights=val * v[col], minlength=n)[doc], minlength=m) / n
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    return size


def _descend(doc, col, val, grades, m, l1, l2, steps) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient steps on the penalized mean negative log likelihood."""
    n, top = len(grades), int(grades.max())
    share = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    cuts, order = np.log(share / (1 - share)), MIN_GAP * np.arange(top)
    w, theta = np.zeros(m), np.maximum.accumulate(cuts - order) + order
    look_w, look_t, pace = w, theta, 1.0
    rate = 1.0 / (0.5 * _steepness(doc, col, val, n, m) + 0.5 + l2)
    at_top, at_zero = grades == top, grades == 0
    for _ in range(steps):
        score = np.bincount(doc, weights=val * look_w[col], minlength=n)
        edge = np.concatenate(([-40.0], look_t, [40.0]))
        up = np.where(at_top, 1.0, _sigmoid(edge[grades + 1] - score))
        low = np.where(at_zero, 0.0, _sigmoid(edge[grades] - score))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p / n, low * (1 - low) / p / n
        g_w = np.bincount(col, weights=val * (d_up - d_low)[doc], minlength=m) + l2 * look_w
        g_t = np.array([d_low[grades == k + 1].sum() - d_up[grades == k].sum() for k in range(top)])
        step_w = look_w - rate * g_w
        new_w = np.sign(step_w) * np.maximum(np.abs(step_w) - rate * l1, 0)
        new_t = np.maximum.accumulate(look_t - rate * g_t - order) + order
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look_w = new_w + (pace - 1) / following * (new_w - w)
        look_t = new_t + (pace - 1) / following * (new_t - theta)
        look_t = np.maximum.accumulate(look_t - order) + order
        w, theta, pace = new_w, new_t, following
    return w, theta


def train(m: Matrix, grades: np.ndarray) -> Severity:
    """Fit weights and thresholds to graded documents: features are chosen with an L1 penalty, then fitted without."""
    grades = np.unique(np.asarray(grades), return_inverse=True)[1]
    if not len(grades) or not grades.max() or not len(m.names):
        return Severity({}, ())
    n = len(grades)
    # Columns of one size, so that the noise of a gradient, and the penalty above it, is the same for all features.
    value = m.value
    size = np.sqrt(np.bincount(m.col, weights=value * value, minlength=len(m.names)) / n)
    pull = np.abs(np.bincount(m.col, weights=value * ((grades > 0) - (grades > 0).mean())[m.doc], minlength=len(size)))
    near = np.sort(np.argsort(-pull / size, kind="stable")[:SCREENED])
    m = m.columns(near).distinct()
    size = np.sqrt(np.bincount(m.col, weights=m.value**2, minlength=len(m.names)) / n)
    value = m.value / size[m.col]
    chosen, _ = _descend(m.doc, m.col, value, grades, len(m.names), NOISE / np.sqrt(n), 0.0, STEPS)
    m = m.columns(np.flatnonzero(chosen))
    weights, theta = _descend(m.doc, m.col, m.value, grades, len(m.names), 0.0, RIDGE, 4 * STEPS)
    return Severity(dict(zip(map(int, m.names), map(float, weights))), tuple(map(float, theta)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Severity:
    rows = feature_counts(sample(docs, labels, "toxic", per_class))
    if not rows:
        return Severity({}, ())
    matrix = feature_matrix(rows)
    return train(matrix, grade_labels(rows, matrix))


def severities(docs: DataFrame, model: Severity) -> DataFrame:
    """``(doc_id, severity, p_toxic, grade, toxic)``: expected grade, P(grade > 0), likeliest grade, decision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            p = scorer.probabilities(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(p @ np.arange(p.shape[1])),
                    pa.array(1.0 - p[:, 0]),
                    pa.array(p.argmax(axis=1).astype(np.int32)),
                    pa.array(1.0 - p[:, 0] >= REJECT_AT),
                ],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    schema = "doc_id bigint, severity double, p_toxic double, grade int, toxic boolean"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Severity) -> DataFrame:
    """The rows of ``docs`` that the model does not reject."""

    @F.pandas_udf("boolean")
    def rejected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            p = scorer.probabilities([t if t is None else t.encode("utf-8", "surrogatepass") for t in texts])
            yield pd.Series(1.0 - p[:, 0] >= REJECT_AT)

    return docs.filter(~rejected("text"))
