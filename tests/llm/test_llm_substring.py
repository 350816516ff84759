"""Substring dedup by level-wise doubling against a plain version that compares every window."""

from __future__ import annotations

import hashlib
import random
import re

import llm_plain as plain
import numpy as np
import pytest
from conftest import SF_DIR

from namefold.llm import queries, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_dedup(rows, window=substring.WINDOW):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    first: dict = {}
    for d, w in words:
        if d is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        covered = set()
        if d is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s:s + window])] < d:
                    covered.update(range(s, s + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in covered)
        out.append((d, len(w), len(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_dedup_on_documents(spark, ws):
    docs = queries.table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = result(substring.dedup(docs, ws))
    assert got == plain_dedup(rows)
    assert any(r[2] for r in got)


def _texts(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "c", "d", "é", "ab c", "x\x1cy"]
    passage = " ".join(rng.choice(vocab) for _ in range(9))
    out = []
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = passage.split(" ")
        out.append(" \t".join(words) if i % 3 else "\n".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedup_levels_on_small_windows(spark, ws, seed):
    texts = _texts(seed)
    rows = [(i % 23 if i % 17 else None, t) for i, t in enumerate(texts)] + [(5, texts[5]), (40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window, base in [(6, 2), (7, 7), (5, 1)]:
        assert result(substring.dedup(docs, ws, window, base)) == plain_dedup(rows, window), (window, base)


def test_dedup_hard_rows_and_hot_passages(spark, ws, monkeypatch):
    monkeypatch.setattr(substring, "HOT_MIN", 2)
    monkeypatch.setattr(substring, "HOT_KEYS", 4)
    shared = " ".join(f"p{i}" for i in range(60))
    rows = plain.edge_rows() + [(100 + i, f"lead{i} {shared} tail{i % 3}", "en", "s", 0, *["x"] * 12) for i in range(30)]
    docs = plain.edge_docs(spark, rows)
    got = result(substring.dedup(docs, ws))
    assert got == plain_dedup([(r[0], r[1]) for r in rows])
    assert sum(1 for r in got if r[0] is not None and r[0] > 100 and r[2] >= 60) == 29
    assert substring.dedup(plain.edge_docs(spark, []), ws).count() == 0


def test_chain():
    assert substring.chain(50) == [1, 2, 4, 7, 13, 25, 50]
    assert substring.chain(1) == [1]


@pytest.mark.parametrize("span", [1, 2, 5, 38])
def test_marks_are_the_first_smallest(span):
    rng = np.random.default_rng(span)
    for top in (3, 1 << 60):
        h = rng.integers(0, top, 400).astype(np.uint64)
        got = substring._marks(h, span)
        assert got.tolist() == [s + int(np.argmin(h[s:s + span])) for s in range(len(h) - span + 1)]


def test_few_positions_are_exchanged(spark, ws, monkeypatch):
    """Of texts without a common passage only marks are grouped, about one in 20 words, and copies go as one text."""
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(400)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i]) for i in range(10)]
    grouped = {}
    attach = substring._attach

    def counted(positions, keys, ws, name):
        grouped[name] = positions.count()
        return attach(positions, keys, ws, name)

    monkeypatch.setattr(substring, "_attach", counted)
    got = result(substring.dedup(spark.createDataFrame(rows, "doc_id long, text string"), ws))
    assert got == plain_dedup(rows)
    assert grouped["groups"] == 0 and 0 < grouped["marks"] < 30 * 400 / 10
