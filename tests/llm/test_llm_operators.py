"""The dealt operators against plain versions, on given tables and on documents with every hard case."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import types
import zlib

import duckdb
import llm_plain as plain
import numpy as np
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from namefold.llm import (
    bitslice, decontam, licenses, mixing, multiset, quality, queries, secret_forest, simhash, token_orc, toxicity, urls,
)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text, source from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(values):
    return sorted(values, key=repr)


def empty(spark):
    return plain.edge_docs(spark, [])


# toxicity


def test_toxicity_on_labels(spark):
    docs, labels = (queries.table(spark, SF_DIR, t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = {r.doc_id: r for r in toxicity.severities(docs, model).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    wrong = sum(found[i].toxic != bool(t) for i, t in known.items())
    assert wrong <= 0.1 * len(known)
    assert all(0 <= r.severity <= 3 and 0 <= r.p_toxic <= 1 for r in found.values())
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).select("doc_id").collect()}
    assert kept == {i for i, r in found.items() if not r.toxic}


def test_toxicity_orders_grades(spark):
    def row(i, text):
        n, features, counts = toxicity.counted(text.encode())
        return types.SimpleNamespace(doc_id=i, label=int(i > 0), n_words=n, features=features, counts=counts)

    rng = random.Random(3)
    made, grades = [], []
    for i in range(400):
        g = i % 4
        made.append(row(g, " ".join(rng.choices(["fine", "plain", "good", "day"], k=60) + ["vile"] * (2 * g))))
        grades.append(g)
    model = toxicity.train(toxicity.feature_matrix(made), np.array(grades))
    scorer = toxicity.Scorer(model)
    p = scorer.probabilities([("fine " * 60 + "vile " * k).encode() for k in (0, 2, 4, 6)])
    severity = p @ np.arange(4)
    assert (np.diff(severity) > 0.3).all() and np.allclose(p.sum(axis=1), 1)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(7, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(plain.edge_docs(spark), labels)
    assert model.thresholds == ()
    found = toxicity.severities(plain.edge_docs(spark), model)
    assert found.count() == 12 and found.filter("severity <> 0 or toxic").count() == 0
    assert toxicity.severities(empty(spark), model).count() == 0
    assert toxicity.keep_clean(plain.edge_docs(spark), model).columns == plain.edge_docs(spark).columns


# token ids


def _encoded(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.op_vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids + [token_orc.END_ID] for x in texts]


def test_token_ids_equal_the_tokenizer(spark, documents, ws):
    found = sorted(rows(queries.op2_token_orc(spark, SF_DIR)))
    start, expected = 0, []
    for (i, _, _), ids in zip(documents, _encoded([t for _, t, _ in documents])):
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected


def test_word_encoder_on_hard_texts():
    rng = random.Random(1)
    letters = list("aZé'. -0<|ß×÷é ,\n ÀΣ²") + ["'s", "'ll", "<|endoftext|>"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["İstanbul K ΑΣ. ΑΣ", "日本語 テスト…*** x…***", "<|ENDOFTEXT|> Ab<|startoftext|>", "a\x1cb\x85e", "\0 a\0b"]
    encoder = token_orc.WordEncoder(queries.op_vocabulary(), limit=50)
    assert [np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() for t in texts] == _encoded(texts)


def test_word_merges_equal_the_model(monkeypatch):
    """The merge engine gives the model's ids for every vocabulary entry and random words, and a worker loads it once."""
    vocabulary = queries.op_vocabulary()
    work = token_orc.encoder(vocabulary, token_orc.END_ID)
    assert work is token_orc.encoder(vocabulary, token_orc.END_ID) and work.merges is not None
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzßàéêöøÿ"
    words = {t.removesuffix("</w>") for t in work.tokenizer.get_vocab()}
    words = {w for w in words if w and all(c in letters for c in w)}
    words |= {"".join(rng.choice(letters) for _ in range(rng.randint(1, 20))) for _ in range(3000)}
    words |= {"".join(rng.sample(sorted(words), 2)) for _ in range(3000)}
    words = sorted(w.encode() for w in words)
    fast = work._heads(words)
    assert len(fast) == len(words)
    monkeypatch.setattr(work, "merges", None)
    assert fast == work._heads(words)


def test_words_are_met_once_a_slice(spark, ws, monkeypatch):
    """Only distinct words of many texts are looked up, known ones are not encoded again, and slices change no ids."""
    work = token_orc.WordEncoder(queries.op_vocabulary(), limit=40)
    asked, learned, known, learn = [], [], work._known, work._learn
    monkeypatch.setattr(work, "_known", lambda words: (asked.append(words.to_pylist()), known(words))[1])
    monkeypatch.setattr(work, "_learn", lambda new: (learned.extend(new.to_pylist()), learn(new))[1])
    texts = [" the  cat's The\tgarden. ", None, "", "the garden. " * 50, "cat's <|endoftext|> Garden."]
    for found in (work.encode_all(pa.array(texts)), work.encode_all(pa.array(texts))):
        assert found.to_pylist() == _encoded(texts)
    assert all(len(words) == len(set(words)) < 10 for words in asked) and len(asked) == 2
    assert sorted(learned) == sorted(asked[0])
    many = [f"word{i} the {i}, garden" for i in range(200)]
    assert work.encode_all(pa.array(many)).to_pylist() == _encoded(many) and len(work.words) <= 40
    docs = spark.createDataFrame(list(enumerate(texts + many)), "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(token_orc, "SLICE_BYTES", 100)
    monkeypatch.setattr(token_orc, "OUT_ROWS", 3)
    found = token_orc.encode(docs, queries.op_vocabulary()).collect()
    assert [(r.doc_id, r.n_tokens, r.ids) for r in found] == [(i, len(x), x) for i, x in enumerate(_encoded(texts + many))]


def test_token_files(spark, ws, tmp_path):
    path = f"{ws.path}/tokens"
    token_orc.write(plain.edge_docs(spark), path, queries.op_vocabulary())
    stored = token_orc.read(spark, path).orderBy("position").collect()
    expected = sorted(plain.edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [(r.doc_id, list(r.ids)) for r in stored] == list(zip([r[0] for r in expected], _encoded([r[1] for r in expected])))
    assert [r.doc_id for r in token_orc.lookup(spark, path, F.col("doc_id") == 10).collect()] == [10]
    digests = token_orc.digests(spark, path)
    assert sum(r.n_tokens for r in digests.collect()) == sum(len(r.ids) for r in stored)
    part = next(p for p in spark.read.orc(path).inputFiles())
    assert orc.ORCFile(part.removeprefix("file://")).nrows > 0
    token_orc.write(empty(spark), f"{ws.path}/none", queries.op_vocabulary())
    assert token_orc.digests(spark, f"{ws.path}/none").count() == 0


# quality


def test_quality_on_held_out(spark):
    found = {r.doc_id: r for r in queries.op3_subword_quality(spark, SF_DIR).collect()}
    known = {r.doc_id: r.quality for r in queries.table(spark, SF_DIR, "labels").collect()}
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7)
    held = [(found[i].score, q) for i, q in known.items() if found[i].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / max(1, len(good) * len(bad)) >= 0.9


def test_quality_features_do_not_depend_on_the_batch():
    texts = ["One two  two", "", " ", "é\n\tab", "x", plain.LONG, "One two  two"]
    model = quality.Quality(np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32), 0.1)
    together = quality.scores(texts, model)
    assert np.allclose(together, [quality.scores([t], model)[0] for t in texts])
    assert together[1] == together[2] == 1 / (1 + np.exp(-0.1))


def test_quality_edges(spark):
    labels = spark.createDataFrame([(7, 1, None), (None, 0, 1), (4, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(plain.edge_docs(spark), labels)
    found = quality.predicted(plain.edge_docs(spark), model)
    assert found.count() == 12 and found.filter("score <> 0.5 or predicted <> 0 or held_out is null").count() == 0
    assert quality.predicted(empty(spark), model).count() == 0


# fingerprints


def test_multiset_against_plain(spark, documents):
    found = sorted(rows(queries.op4_multiset_hash(spark, SF_DIR)))
    texts = [t or "" for _, t, _ in documents]
    for k, r in enumerate(found):
        following = texts[(k + 1) % len(texts)]
        changed = multiset.edited(texts[k], following)
        a, b, c = (multiset.fingerprint(t) for t in (texts[k], changed, following))
        assert r[:3] == (documents[k][0], len(texts[k]), hashlib.sha256(changed.encode()).hexdigest())
        assert r[3:] == (multiset.encoded(a), multiset.encoded(b), multiset.likeness(a, b), multiset.likeness(a, c))
    assert np.median([r[5] for r in found]) > 0.6 and np.median([r[6] for r in found]) < 0.3


def test_multiset_is_homomorphic():
    parts = ["first line", "second", "second", "third é", plain.LONG]
    total = multiset.empty()
    for p in parts:
        total = multiset.insert(total, p)
    assert multiset.encoded(total) == multiset.encoded(multiset.fingerprint("\n".join(reversed(parts))))
    less = multiset.delete(total, "second")
    assert multiset.encoded(less) == multiset.encoded(multiset.fingerprint("\n".join(parts[:2] + parts[3:])))
    assert multiset.encoded(less) != multiset.encoded(total)
    again = multiset.decoded(multiset.encoded(total))
    assert multiset.likeness(total, again) == 1.0


def test_multiset_digests_true_bytes():
    # NUL and SOH differ in the text, so the fingerprints differ; the sketch may treat them alike.
    a, b = multiset.fingerprint("a\0b\nc"), multiset.fingerprint("a\1b\nc")
    assert multiset.encoded(a) != multiset.encoded(b)
    assert multiset.likeness(a, b) < 1.0 or not np.array_equal(a[0], b[0])
    assert multiset.encoded(multiset.fingerprint("a\0b\nc")) == multiset.encoded(multiset.fingerprint("c\na\0b"))


def test_multiset_edges(spark):
    found = rows(multiset.compared(plain.edge_docs(spark)))
    source = sorted(plain.edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in source]
    expected = []
    for k, t in enumerate(texts):
        changed = multiset.edited(t, texts[(k + 1) % len(texts)])
        expected.append((source[k][0], len(t), hashlib.sha256(changed.encode()).hexdigest()))
    assert ordered(r[:3] for r in found) == ordered(expected)
    assert multiset.compared(empty(spark)).count() == 0
    assert multiset.compared(plain.edge_docs(spark).filter("doc_id = 5")).count() == 1


# secrets


def test_secret_forest(spark, ws):
    made = [(i, f'see token = "{hashlib.sha1(str(i).encode()).hexdigest()}" here') for i in range(60)]
    made += [(100 + i, f"order number {10**15 + 7919 * i} was sent") for i in range(60)]
    made += [(200, None), (201, ""), (202, "plain words only"), (200, "short 1234"), (None, "card 4345168114407329")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in made], "doc_id bigint, text string, candidate string")
    found = rows(secret_forest.scan(docs, ws))
    expected = [(i, m.start(), len(m[0])) for i, t in made for m in re.finditer(r"[0-9a-f]{40}|\b\d{16}\b", t or "")]
    assert ordered(r[:3] for r in found) == ordered(expected)
    assert {r[0] for r in found if r[-1]} == set(range(60))


def test_secret_edges(spark, ws):
    assert secret_forest.scan(empty(spark), ws).count() == 0
    assert secret_forest.scan(plain.edge_docs(spark), ws).count() == 0
    one = plain.edge_docs(spark, [(1, "number 4345168114407329", *[None] * 15)])
    assert [r.score for r in secret_forest.scan(one, ws).collect()] == [0.0]


# mixing


def test_mixing_targets(spark, documents):
    sizes = collections.Counter()
    own = {}
    for i, t, s in documents:
        own[i] = len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s
        sizes[s] += own[i][0]
    expected = plain.targets(sizes)
    found = rows(queries.op6_source_mixing(spark, SF_DIR))
    assert len(found) == len(documents)
    for doc, size, source_size, target, taken in found:
        assert (size, source_size) == (own[doc][0], sizes[own[doc][1]])
        assert target == pytest.approx(expected[own[doc][1]])
        assert taken in [size * c for c in (0, 1, 2, 3)] and abs(taken - size * target / max(1, source_size)) <= size
    assert ordered(found) == ordered(rows(queries.op6_source_mixing(spark, SF_DIR)))


def test_mixing_draws_are_fair(spark):
    draws = [r.d for r in spark.range(20_000).select(mixing.draw_of(F.col("id"), F.lit("")).alias("d")).collect()]
    assert 0 <= min(draws) and max(draws) < 1 and abs(np.mean(draws) - 0.5) < 0.01


def test_mixing_edges(spark, ws):
    sizes = collections.Counter()
    for r in plain.edge_rows():
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    found = rows(mixing.document_takes(plain.edge_docs(spark), ws))
    expected = plain.targets(sizes)
    assert ordered((s, round(t, 6)) for _, _, s, t, _ in set(found)) == ordered(
        (s, round(t, 6)) for s, t in {(d[0], d[1], sizes[d[3]], expected[d[3]]) [2:] for d in plain.edge_rows()} for _ in range(
            len({x for x in found if x[2] == s})
        )
    )
    mixed = mixing.mix(plain.edge_docs(spark), ws)
    assert mixed.columns == plain.edge_docs(spark).columns
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r[4] for r in found)
    assert mixing.document_takes(empty(spark), ws).count() == 0 and mixing.mix(empty(spark), ws).count() == 0


# decontamination


def test_winnowing_against_plain(spark, documents):
    items = duckdb.sql(f"select item_id, text from '{SF_DIR}/benchmark.parquet'").fetchall()
    found = rows(queries.op7_winnowing(spark, SF_DIR))
    expected = plain.hits([(i, t) for i, t, _ in documents], items)
    assert ordered(found) == ordered(expected) and any(r[-1] for r in found)


def test_winnowing_edges(spark, ws):
    items = [
        (1, "same row TWICE over with enough words to make a few shingles"), (2, "école k"), (3, None), (4, ""), (5, "word"),
        (None, "one two three"), (1, "rights reserved"), (6, plain.LONG[:400]), (7, "École K"), (8, "a1 " * 12),
    ]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, key string")
    found = rows(decontam.reports(plain.edge_docs(spark), bench, ws))
    assert ordered(found) == ordered(plain.hits([r[:2] for r in plain.edge_rows()], items))
    kept = decontam.drop_contaminated(plain.edge_docs(spark), bench, ws)
    assert kept.columns == plain.edge_docs(spark).columns and kept.count() == sum(not r[-1] for r in found)
    assert decontam.reports(empty(spark), bench, ws).count() == 0
    assert decontam.reports(plain.edge_docs(spark), bench.limit(0), ws).filter("contaminated").count() == 0


def test_winnowing_on_random_texts(spark, ws):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 14)))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert ordered(rows(decontam.reports(docs, bench, ws))) == ordered(plain.hits(texts, items))


# URLs


def test_urls_edges(spark):
    made = [
        (1, "HTTP://WWW.Example.ORG/es/1?x#y"), (2, "https://a.com/fr/"), (3, "https://a.com/de/x"), (4, None), (5, "no scheme"),
        (6, "http://xn.example.org/en/12"), (7, "http://org"), (8, "http://a.net/porn/x"), (9, "http://a.net/sex-casino"),
        (10, "http://a.net/sex/sex"), (11, "http://essex.net/analytics"), (12, "http://a.com?q=/fr/"), (13, ""), (None, "x://y/z"),
        (15, "http://notexample.org.evil/es/"), (16, "a://b://c/d"), (17, "http://a.net/" + "sex/" * 50_000 + "poker"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in made], "page_id bigint, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert len(found) == len(made)
    assert found[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert found[2] == ("a.com", "/fr/", "com/fr/", "allow") and found[3][2:] == ("com/de/", "block")
    assert found[4] == found[5] == found[13] == ("", "", None, "allow")
    assert found[6][2:] == ("example.org/en/1", "block") and found[7] == ("org", "", None, "allow")
    assert [found[i][3] for i in (8, 9, 10, 11, 17)] == ["block", "block", "allow", "allow", "block"]
    assert found[12] == ("a.com", "", None, "allow") and found[15][2] is None and found[16][:2] == ("b:", "//c/d")
    assert urls.judge(pages.limit(0)).count() == 0


# near copies


def test_simhash_against_plain(spark, documents):
    prints = [plain.simhash(t) for _, t, _ in documents]
    root = plain.components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    expected = [(d[0], format(p, "016x"), documents[r][0]) for d, p, r in zip(documents, prints, root)]
    assert sorted(rows(queries.op9_simhash(spark, SF_DIR))) == expected


@pytest.mark.parametrize("radius,width", [(0, 1), (2, 1), (3, 1), (44, 4)])
def test_bitslice_links(radius, width):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, (40, width), dtype=np.uint64)
    made = []
    for k in range(3000):
        row = base[k % 40].copy()
        for b in rng.integers(0, 64 * width, rng.integers(0, max(1, radius) + 2)):
            row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        made.append(row)
    words = np.unique(np.array(made), axis=0)
    found = bitslice.links(words, radius)
    distance = lambda i, j: int(np.bitwise_count(words[i] ^ words[j]).sum())
    assert len(found) < len(words) and all(distance(i, j) <= radius for i, j in found)
    root = list(range(len(words)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in found:
        root[find(i)] = find(j)
    for i in range(0, len(words), 7):
        near = np.flatnonzero(np.bitwise_count(words ^ words[i]).sum(axis=1) <= radius)
        assert len({find(int(j)) for j in near}) == 1


def test_simhash_hot_buckets_lose_nothing(spark, ws):
    rng = np.random.default_rng(0)
    top = np.uint64(0xABCD1234) << np.uint64(32)
    values = np.unique(top | rng.integers(0, 2**32, 4000, dtype=np.uint64))
    values = np.unique(np.concatenate((values, values[:300] ^ np.uint64(0x10000001), values[:200] ^ np.uint64(1 << 40))))
    nodes = spark.createDataFrame([(i, int(v)) for i, v in enumerate(values.view(np.int64))], "id bigint, f0 bigint")
    found = {(r.u, r.v) for r in simhash.near_edges(nodes, simhash.EXACT, ws, hot=50).collect()}
    every = {(r.u, r.v) for r in simhash.near_edges(nodes, simhash.EXACT, ws, hot=10**6).collect()}

    def classes(edges):
        root = list(range(len(values)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for u, v in edges:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(values))]

    assert classes(found) == classes(every) and len(every) >= 300


def _classes(n, edges):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_near_hot_buckets_lose_nothing(spark, ws):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (60, 4), dtype=np.uint64)
    values = []
    for row in np.repeat(base, 3, axis=0):
        for b in rng.choice(256, 24, replace=False):
            row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        # One band that all share is hot; pairs need not share another.
        row[0] &= ~np.uint64(0xFFF)
        values.append(row)
    table = np.array(values).view(np.int64).tolist()
    nodes = spark.createDataFrame([(i, *r) for i, r in enumerate(table)], "id bigint, f0 bigint, f1 bigint, f2 bigint, f3 bigint")
    every, cut = ({(r.u, r.v) for r in simhash.near_edges(nodes, simhash.NEAR, ws, hot=h).collect()} for h in (10**6, 2))
    distance = lambda i, j: int(np.bitwise_count(values[i] ^ values[j]).sum())
    brute = [(i, j) for i in range(180) for j in range(i) if distance(i, j) <= simhash.NEAR.reach]
    assert len(brute) > 100
    assert _classes(180, cut) == _classes(180, every) == _classes(180, brute)


def test_near_groups_are_bounded(spark, ws):
    rows = [(i, 7, i, 3 * i, 5 * i) for i in range(2000)]
    nodes = spark.createDataFrame(rows, "id bigint, f0 bigint, f1 bigint, f2 bigint, f3 bigint")
    groups = simhash.placed(nodes, simhash.NEAR, ws, hot=100).groupBy("key", "part").count()
    assert groups.agg(F.max("count")).first()[0] <= 400


@pytest.mark.parametrize("radius,width", [(2, 1), (44, 4), (72, 4)])
def test_paired(radius, width):
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, (700, width), dtype=np.uint64)
    words[1] = ~words[0]
    words[5:300:7] = words[2] ^ np.uint64(1)
    distance = np.bitwise_count(words[:, None] ^ words[None]).sum(axis=2, dtype=int)
    np.fill_diagonal(distance, 999)
    assert (bitslice.paired(words, radius) == (distance <= radius).any(axis=1)).all()


def test_simhash_edges(spark, ws):
    found = simhash.components(plain.edge_docs(spark), simhash.EXACT, ws)
    got = {(r.doc_id, r.f0): r.component_id for r in found.collect()}
    assert found.count() == 12
    assert got[(2, 0)] == got[(1, 0)] == got[(9, 0)] == got[(11, 0)] == 1
    assert [v for (i, _), v in got.items() if i is None] == [None] and [v for (i, _), v in got.items() if i == 8] == [7]
    kept = simhash.keep_one(plain.edge_docs(spark), simhash.NEAR, ws)
    assert kept.columns == plain.edge_docs(spark).columns
    assert ordered(r.doc_id for r in kept.collect()) == ordered([1, None, 4, 5, 6, 7, 10])
    assert simhash.keep_one(empty(spark), simhash.NEAR, ws).count() == 0


def test_near_copies_by_similarity(spark, ws):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts, groups = [], []
    for g in range(40):
        words = rng.choices(vocabulary, k=400)
        texts.append(" ".join(words))
        for _ in range(3):
            other = list(words)
            for _ in range(5):
                other[rng.randrange(400)] = rng.choice(vocabulary)
            texts.append(" ".join(other))
        groups += [g] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = [r.doc_id for r in simhash.keep_one(docs, simhash.NEAR, ws).collect()]
    assert sorted(groups[i] for i in kept) == list(range(40))


def _jaccard(a: str, b: str) -> float:
    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("size", [1 << 21, 300])
def test_near_copies_by_exact_similarity(spark, ws, monkeypatch, size):
    rng = random.Random(5)
    monkeypatch.setattr(simhash, "SET_BLOCK", size)
    texts = []
    for g in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((30, 200)))]
        texts.append(" ".join(words))
        for _ in range(4):
            # Copies of a changed beginning, from 0.6 to 0.95.
            n = round(len(words) * rng.uniform(0.02, 0.24))
            texts.append(" ".join([f"x{rng.randrange(10**6)}" for _ in range(n)] + words[n:]))
    # The set of one repeated shingle and of different ends: one fingerprint by counts, no near copies.
    texts += [" ".join(["same"] * 500 + [f"{k}e{i}" for i in range(60)]) for k in "ab"]
    root = plain.components(texts, lambda a, b: _jaccard(a, b) >= 0.8)
    between = [_jaccard(texts[i], texts[5 * (i // 5)]) for i in range(300) if i % 5]
    assert sum(0.8 <= x < 0.85 for x in between) > 10 and sum(0.7 < x < 0.8 for x in between) > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in simhash.keep_one(docs, simhash.NEAR, ws).collect())
    assert kept == [i for i in range(len(texts)) if root[i] == i]


# licenses


def _labels(text: str | None) -> tuple:
    text = text or ""
    w, starts, base = plain.words(text), [], set()
    for phrase, label in licenses.BASE:
        parts = phrase.split()
        for a in range(len(w) - len(parts) + 1):
            if w[a : a + len(parts)] == parts:
                starts.append(a)
                base.add(label)
    import regex

    low = text.lower()
    flat = re.sub(r"[ \t\n\x0b\f\r]+", " ", low)
    met = []
    if any(a in low for a in licenses.ANCHORS):
        met = [
            (m.start(), m.end(), r.priority, r.label)
            for r in licenses.rules()
            if r.keyword in flat
            for m in regex.finditer(r.expression, flat)
        ]
    kept = [
        x
        for x in met
        if not any(
            (e[2] > x[2] and e[0] < x[1] and x[0] < e[1])
            or (e[2] == x[2] and e[:2] != x[:2] and e[0] <= x[0] and e[1] >= x[1])
            for e in met
        )
    ]
    both = sorted(base | {x[3] for x in kept})
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(w), len(starts), *ends, ",".join(sorted(base)), ",".join(both)


NOTICES = [
    "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License",
    "Licensed under the Apache License, Version 2.0, or the MIT license. Copyright (c) 2020 X. All rights reserved.",
    "cc by cc by-sa 4.0 CC-BY", "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    "SPDX-License-Identifier: GPL-3.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining",
    "the lesser general public license 2.1 and general public license v2", "placed in the public domain", "cc0 1.0",
    "GENERAL\nPUBLIC,LICENSE general public license", "nothing to see", "mitten licensed undermit",
]


def test_license_rules_against_plain(spark, documents):
    assert 200 < len(licenses.rules()) < 1000
    assert all(any(a in n.lower() for a in licenses.ANCHORS) for n in NOTICES[:10])
    texts = [(i, t) for i, t, _ in documents] + [(10_000 + i, t) for i, t in enumerate(NOTICES)] + [r[:2] for r in plain.edge_rows()]
    texts += [(20_000, " ".join(NOTICES * 20))]
    docs = spark.createDataFrame([(*r, "x") for r in texts], "doc_id bigint, text string, flat string")
    found = rows(licenses.scan(docs))
    assert ordered(r[:-1] for r in found) == ordered((i, *_labels(t)) for i, t in texts)
    assert all(0 <= r[-1] <= 1 and (r[-1] > 0) == bool(r[-2]) for r in found)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_rules_without_anchor_words(spark):
    expected = {
        "apache 2.0": "apache-2.0", "mozilla public 2.0": "mpl-2.0", "General Public v3": "gpl-3", "artistic 2.0": "artistic-2.0",
        "CC  BY-NC 4.0": "cc-by-nc-4.0", "cc\tby 3.0": "cc-by-3.0", "CC\r\nBY": "cc-by", "subject\nto the MIT license": "mit",
        "GPLv3": "gpl-3", "LGPL 2.1": "lgpl-2.1", "AGPL-3.0": "agpl-3.0", "MPL 2.0": "mpl-2.0", "success": "", "limit 2.0": "",
    }
    docs = spark.createDataFrame(list(enumerate(expected)), "doc_id bigint, text string")
    found = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(docs).collect()}
    for i, (text, label) in enumerate(expected.items()):
        assert found[i] - {"cc-by"} == {label} - {"cc-by"} or found[i] == {label}, (text, found[i])


def test_multiset_last_window_of_a_piece():
    step = multiset.PIECE
    text = "".join(random.Random(4).choices("abcdefgh", k=step))
    whole = multiset.fingerprint(text)
    inserted = multiset.insert(multiset.empty(), text)
    windows = [(bytes(multiset.WINDOW) + text.encode())[i : i + multiset.WINDOW] for i in range(step, step + 1)]
    shape = multiset._shape(bytes(multiset.WINDOW) + text.encode())
    shorter = multiset._shape(bytes(multiset.WINDOW) + text.encode()[:-1])
    assert (whole[1] == inserted[1]).all()
    assert (shape - shorter == multiset._shape(windows[0])).all() and (shape != shorter).any()
