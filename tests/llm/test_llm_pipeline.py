"""The pipeline against a version without Spark, stage by stage, and on documents with every hard case."""

from __future__ import annotations

import os
import struct
import zlib

import corpus_pipeline
import llm_plain as plain
import numpy as np
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from namefold.llm import mixing, queries, simhash, token_orc, toxicity


def toxic_gone(docs, model):
    scorer = toxicity.Scorer(model)
    p = scorer.probabilities([None if t is None else t.encode() for _, t, _ in docs])
    return [d for d, x in zip(docs, 1 - p[:, 0]) if x < toxicity.REJECT_AT]


def near_gone(docs):
    """All pairs of texts are compared by the Jaccard similarity of their sets of five-word shingles."""
    sets = [set(simhash.shingle_hashes((text or "").encode(), simhash.NEAR.shingle).tolist()) for _, text, _ in docs]
    num, den = simhash.SIMILAR

    def similar(x, y):
        both = len(x & y)
        return den * both >= num * (len(x) + len(y) - both)

    root = plain.components(sets, similar)
    return [d for i, d in enumerate(docs) if root[i] == i]


def drawn(doc_id):
    first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    return (xxhash.xxh64_intdigest(struct.pack("<i", mixing.SEED), first) >> 11) * 2.0**-53


def mixed(docs):
    sizes: dict = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    targets = plain.targets(sizes)
    out = []
    for d in docs:
        rate = targets[d[2]] / sizes[d[2]] if sizes[d[2]] else 0
        out += [d] * (int(rate) + (drawn(d[0]) < rate - int(rate)))
    return out


def tokens(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.op_vocabulary())
    start, out = 0, []
    for doc_id, text, _ in sorted(docs):
        ids = t.encode(text or "", add_special_tokens=False).ids + [token_orc.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage."""
    docs = queries.table(spark, SF_DIR, "documents")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append((name, docs))
    return found


def triples(df):
    return sorted((r.doc_id, r.text, r.source) for r in df.collect())


def test_stages_against_plain(spark, stages):
    (_, docs), (_, clean), (_, distinct), (_, apart), (_, mix), (_, ids) = stages
    model = toxicity.fit(docs, queries.table(spark, SF_DIR, "labels"))
    assert triples(clean) == toxic_gone(triples(docs), model)
    assert triples(distinct) == near_gone(triples(clean))
    items = [(r.item_id, r.text) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    hit = {r[0] for r in plain.hits([d[:2] for d in triples(distinct)], items) if r[-1]}
    assert triples(apart) == [d for d in triples(distinct) if d[0] not in hit]
    assert triples(mix) == mixed(triples(apart))
    assert sorted(map(tuple, ids.collect())) == tokens(triples(mix))
    assert all(df.columns == docs.columns for _, df in stages[:-1])
    assert len(triples(docs)) > len(triples(clean)) > len(triples(distinct)) > 0


def test_run_equals_the_stages(spark, stages):
    found = contract.queries()["pipeline"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[-1][1].collect()))
    assert "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("keep", [True, False])
def test_hard_rows(spark, tmp_path, keep):
    docs = plain.edge_docs(spark)
    docs = docs if keep else docs.filter(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert (docs.count() > 0) == keep


def test_near_copies_exchange_texts_once(spark, ws):
    """A join that deals the texts by their key also brings repeated rows together; rows are as with a broadcast."""
    texts = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(6)]
    rows = [(i % 5 if i else None, texts[i % 6]) for i in range(12)] + [(3, texts[3]), (None, texts[0]), (0, texts[0]), (9, None)]
    docs = spark.createDataFrame([(d, t, f"s{k}") for k, (d, t) in enumerate(rows)], "doc_id long, text string, source string")
    expected = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs, simhash.NEAR, ws).collect()), key=repr)
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t, []).append(d)
    assert expected == sorted(((min((d for d in ids if d is not None), default=None), t) for t, ids in by_text.items()), key=repr)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = simhash.keep_one(docs, simhash.NEAR, ws)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_only_read_tables_stay(spark, ws, tmp_path, monkeypatch):
    """The near-copy stage leaves its kept rows alone, and a run the rows of its last stage."""
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(4)]
    texts += [t.replace("x30", "y") for t in texts[:2]] + [None, texts[3]]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = simhash.keep_one(docs, simhash.NEAR, ws)
    assert [p.split("-", 1)[1] for p in os.listdir(ws.path.removeprefix("file:"))] == ["kept"]
    assert triples(found.na.fill("")) == sorted((i, texts[i] or "", f"s{i}") for i in (0, 1, 2, 3, 6))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    steps = [(f"less{k}", lambda s, d, _, k=k: d.filter(F.col("doc_id") != k)) for k in (0, 1, 2)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", steps)
    left = corpus_pipeline.run(spark, str(tmp_path))
    folder = os.path.dirname(os.path.dirname(left.inputFiles()[0].replace("file://", "")))
    assert [p.split("-", 1)[1] for p in os.listdir(folder)] == ["less2"]
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 7]
