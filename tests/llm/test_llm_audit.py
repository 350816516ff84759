"""Source divergence audit against a dense plain version, with spills, hard rows and an empty table."""

from __future__ import annotations

import collections
import re

import llm_plain as plain
import pytest
from conftest import SF_DIR

from namefold.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, min_docs, top=divergence.TOP):
    """Every group against every kept term, densely, in Python integers."""
    counts, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = collections.Counter(TERM.findall((text or "").translate(plain.UPPER)))
        for t, n in terms.items():
            counts[lang, source, t] += n
            docs[lang, t] += 1
    kept = collections.defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)

    def p(c, total, v):
        return 1 + 1_000_000_000 * (c + 5) // (total + 5 * v)

    out = []
    for lang in {g[0] for g in groups}:
        terms, v = kept[lang], len(kept[lang])
        sources = sorted(s for g, s in groups if g == lang)
        total = {s: sum(counts[lang, s, t] for t in terms) for s in sources}
        value = {s: {t: p(counts[lang, s, t], total[s], v) for t in terms} for s in sources}
        lang_n = {t: sum(counts[lang, s, t] for s in sources) for t in terms}
        lang_p = {t: p(lang_n[t], sum(lang_n.values()), v) for t in terms}
        order = lambda r: (-r[1], r[0].encode())
        for s in sources:
            pairs = sorted(((o, sum(abs(value[s][t] - value[o][t]) for t in terms)) for o in sources if o != s), key=order)
            out += [(lang, s, "pair", o, x, i + 1) for i, (o, x) in enumerate(pairs)]
            above = [(t, value[s][t] - lang_p[t]) for t in terms if counts[lang, s, t] > 0 and value[s][t] > lang_p[t]]
            out += [(lang, s, "term", t, x, i + 1) for i, (t, x) in enumerate(sorted(above, key=order)[:top])]
    return sorted(out)


def triples(df):
    return [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]


@pytest.mark.parametrize("block_terms", [divergence.BLOCK_TERMS, 7])
def test_audit_against_plain(spark, ws, block_terms):
    docs = queries.table(spark, SF_DIR, "documents")
    got = sorted(tuple(r) for r in divergence.audit(docs, ws, 10, 5, block_terms).collect())
    assert got == plain_audit(triples(docs), 10, 5)
    assert {r[2] for r in got} == {"pair", "term"}


def test_audit_hard_rows(spark, ws):
    rows = plain.edge_rows() + [(20 + i, f"Gamma delta gamma {i}", "de", "x" if i % 2 else None, 0, *["x"] * 12)
                                for i in range(6)]
    docs = plain.edge_docs(spark, rows)
    got = divergence.audit(docs, ws, 2, 3, 3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(triples(docs), 2, 3)


def test_audit_without_kept_terms_and_empty(spark, ws):
    docs = plain.edge_docs(spark)
    got = sorted(tuple(r) for r in divergence.audit(docs, ws, 1000).collect())
    assert got == plain_audit(triples(docs), 1000) and {r[4] for r in got} == {0}
    assert divergence.audit(plain.edge_docs(spark, []), ws).count() == 0


def test_merge_carries_keys_across_batches():
    import pyarrow as pa

    keys = [("a", "s", "t")] * 3 + [("a", "s", "u")] * 2 + [("b", "s", "t")]
    batch = lambda part: pa.RecordBatch.from_arrays(
        [pa.array([k[i] for k in part]) for i in range(3)] + [pa.array([1] * len(part))] * 2,
        ["lang", "source", "term", "n", "docs"],
    )
    out = pa.Table.from_batches(list(divergence._merge(iter([batch(keys[:2]), batch(keys[2:4]), batch(keys[4:])]))))
    assert sorted(zip(*(out.column(c).to_pylist() for c in ("lang", "term", "n")))) == [
        ("a", "t", 3), ("a", "u", 2), ("b", "t", 1)]
