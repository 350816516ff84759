"""Plain versions of the dealt operators, and documents with every hard case, for the tests."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import xxhash

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, size string, id string, "
    "f0 string, root string, label string, place string, words string, hashes string, n string, rate string, code string"
)
LONG = " ".join(f"long{i % 997} étude{i % 13}" for i in range(30_000))


def edge_rows() -> list[tuple]:
    texts = [
        (1, "", "a"),
        (2, None, "a"),
        (None, "A document without an id but with more than ten words of text in it", "b"),
        (4, "Word", None),
        (5, "one two three", None),
        (6, LONG, "b"),
        (7, "The same row twice over, with enough words to make a few shingles of it", "c"),
        (7, "The same row twice over, with enough words to make a few shingles of it", "c"),
        (8, "The same row twice over, with enough words to make a few shingles of it", ""),
        (9, " \t\n ", "c"),
        (10, "ÉCOLE école K İstanbul ΑΣ\nLicensed under CC BY-NC 4.0.\n\nAll  rights\nreserved", "c"),
        (11, None, None),
    ]
    return [(i, t, "en", s, None if t is None else len(t), *["x"] * 12) for i, t, s in texts]


def edge_docs(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)


def words(text: str | None) -> list[str]:
    return PLAIN.findall((text or "").translate(UPPER))


def hits(documents: list[tuple], items: list[tuple]) -> list[tuple]:
    """op7: (doc_id, n_words, n_hit, n_items, sha256, contaminated) for (id, text) on both sides."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for a in range(len(w) - m + 1):
            if m:
                windows[tuple(w[a : a + m])].add(item)
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for m in {len(k) for k in windows}:
            for a in range(len(w) - m + 1):
                own = windows.get(tuple(w[a : a + m]))
                if own:
                    hit.update(range(a, a + m))
                    found |= own
        listed = ",".join(sorted(str(i) for i in found if i is not None))
        n = len([i for i in found if i is not None])
        out.append((doc, len(w), len(hit), n, hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def simhash(text: str | None, k: int = 3) -> int:
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[a : a + k]) for a in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def components(values: list, linked) -> list[int]:
    """The smallest index reachable from each index."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def targets(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """op6: share all sizes by weight, again and again, until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total >= cap * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in full:
            out[s] = float(cap * sizes[s])
            free.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out
