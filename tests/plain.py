"""Small plain-Python versions of the operators, used as an independent yardstick on tiny inputs."""

from __future__ import annotations

import math
from collections import Counter


def grams(name: str, lo: int, hi: int) -> list[str]:
    out = []
    for word in name.lower().split():
        padded = f" {word} "
        for n in range(lo, hi + 1):
            out += [padded[i : i + n] for i in range(max(1, len(padded) - n + 1))]
            if len(padded) <= n:
                break
    return out


def vectors(names: list[str], lo: int, hi: int, max_df: float = 0.95) -> list[dict[str, float]]:
    counts = [Counter(grams(n, lo, hi)) for n in names]
    df = Counter(g for c in counts for g in c)
    total = len(names)
    out = []
    for c in counts:
        raw = {
            g: (1 + math.log(tf)) * (math.log((1 + total) / (1 + df[g])) + 1)
            for g, tf in c.items()
            if df[g] <= max_df * total
        }
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.append({g: w / norm for g, w in raw.items()})
    return out


def similarities(names: list[str], threshold: float, lo: int, hi: int) -> dict[tuple[int, int], float]:
    """Ordered pairs above the threshold, each vector with itself included."""
    vecs = vectors(names, lo, hi)
    out = {}
    for i, x in enumerate(vecs):
        for j, y in enumerate(vecs):
            sim = round(sum(w * y.get(g, 0.0) for g, w in x.items()), 9)
            if sim > threshold:
                out[i, j] = sim
    return out


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, start=1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a: str, b: str) -> float:
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def roots(count: int, edges) -> list[int]:
    parent = list(range(count))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in edges:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def one_pass(names: list[str], params) -> dict[str, str]:
    """Name -> name of its cluster after one round; ``names`` in (length, name) order."""
    sims = similarities(names, params.threshold, *params.ngram_range)
    edges = []
    for i in range(len(names)):
        ranked = sorted((-sim, j) for (a, j), sim in sims.items() if a == i)[: params.top_n]
        edges += [(i, j) for _, j in ranked if j != i]
    out = {}
    for i, root in enumerate(roots(len(names), edges)):
        weak = root != i and ratio(names[root], names[i]) < params.fuzz
        out[names[i]] = names[i] if weak else names[root]
    return out


def representatives(cleaned: list[str], cfg) -> dict[str, str]:
    """Cleaned name -> final representative after all rounds."""
    level = sorted({n for n in cleaned if n.strip()}, key=lambda n: (len(n), n))
    result = {n: n for n in level}
    for params in (cfg.precision, cfg.recall, cfg.merge):
        step = one_pass(level, params)
        result = {n: step[r] for n, r in result.items()}
        level = [n for n in level if step[n] == n]
    return result
