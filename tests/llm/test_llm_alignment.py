"""Cross-tokenizer alignment against a plain version: cuts by set intersection, links by testing every pair."""

from __future__ import annotations

import collections
import hashlib
import random

import llm_plain as plain
import pytest
from conftest import SF_DIR

from namefold.llm import alignment, queries


@pytest.fixture(scope="module")
def work():
    return alignment.aligner(*alignment._paths(None, None))


def plain_rows(work, rows):
    per_row = []
    for doc_id, text in rows:
        if not text:
            per_row.append((doc_id, None))
            continue
        ia = work.a.encode(" " + text, add_special_tokens=False).ids
        ib = work.b.encode(text)
        target = (" " + text).encode()
        if b"".join(work.a_bytes[i] for i in ia) != target or b"".join(work.b_bytes[i] for i in ib) != target:
            per_row.append((doc_id, None))
            continue
        spans = lambda ids, table: [(sum(len(table[x]) for x in ids[:k]), sum(len(table[x]) for x in ids[:k + 1]))
                                    for k in range(len(ids))]
        sa, sb = spans(ia, work.a_bytes), spans(ib, work.b_bytes)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        found, start = [], 0
        for c in cuts:
            found.append(([x for x, (s, e) in zip(ia, sa) if start <= s and e <= c],
                          [x for x, (s, e) in zip(ib, sb) if start <= s and e <= c]))
            start = c
        linked = [(x, y) for x, (s, e) in zip(ia, sa) for y, (t, f) in zip(ib, sb) if s < f and t < e]
        per_row.append((doc_id, (len(ia), len(ib), found, linked)))
    counts = collections.Counter(p for _, r in per_row if r for p in set(r[3]))
    top = collections.defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for doc_id, r in per_row:
        if r is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, found, linked = r
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append((doc_id, n_a, n_b, len(found), len(linked), sum(counts[p] == top[p[0]] for p in linked),
                    sum(counts[p] for p in linked), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_alignment_on_documents(spark, ws, work):
    docs = queries.table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").filter("length(text) < 3000").collect()]
    got = result(alignment.alignment(docs.filter("length(text) < 3000"), ws))
    assert got == plain_rows(work, rows)
    assert sum(1 for r in got if r[1]) > len(got) // 4


def test_alignment_hard_rows(spark, ws, work):
    rng = random.Random(7)
    pieces = ["the", " ", "é", "<|endoftext|>", "<s>", "</s>", "x", "42", "日本", "▁", "ab", ".", "  "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (100, None), (101, ""), (102, "a\nb")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0, *["x"] * 12) for d, t in rows], plain.SCHEMA)
    got = result(alignment.alignment(docs, ws))
    assert got == plain_rows(work, rows)
    assert any(r[1] for r in got if r[0] < 100)
    assert alignment.alignment(plain.edge_docs(spark, []), ws).count() == 0


def test_groups_split_at_every_shared_end():
    ea, eb = [1, 3, 4, 6, 9], [2, 3, 6, 7, 8, 9]
    assert alignment.groups(ea, eb) == [(0, 2, 0, 2), (2, 4, 2, 3), (4, 5, 3, 6)]
    assert alignment.groups([5], [1, 2, 5]) == [(0, 1, 0, 3)]


def test_words_equal_whole_texts(work, monkeypatch):
    """Texts put together from aligned words equal texts aligned as a whole; the words are aligned once."""
    rng = random.Random(11)
    pieces = ["the", "The", "é", "e\u0301", "\u0301", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "x", "42", "日本", "▁", "ab", ".", "'s",
              "ﬁ", "\U0001f44d", "\u200b"]
    blanks = ["\u00a0", "\t", "\x1c"]
    texts = []
    for _ in range(1500):
        words = ["".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 8))]
        seps = rng.choices([" ", "\n", "\n\n"] if rng.random() < 0.7 else [" ", "  ", " \n", *blanks], k=len(words))
        texts.append("".join(w + s for w, s in zip(words, seps)).rstrip(" \n" if rng.random() < 0.8 else "") or "a")
    texts += [None, "", " ", "\n", "\na b", "a\n b", "a \nb"]
    expected = [f and alignment._word(*f) for f in work.align(texts)]
    monkeypatch.setattr(alignment, "CACHE_WORDS", 500)
    work.words.clear()
    whole = []
    monkeypatch.setattr(work, "align", lambda t, f=work.align: whole.extend(t) or f(t))
    got = [r for a in range(0, len(texts), 64) for r in work.rows(texts[a:a + 64])]
    assert got == expected
    assert 0 < len(whole) < len(texts) * 0.8 and work.words
    work.words.clear()
