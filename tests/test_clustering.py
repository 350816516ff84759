from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

import plain
import pytest
from pyspark.sql import functions as F

from namefold.config import PassParams, ResolveConfig
from namefold.operators import components, features, names, neighbours, simjoin
from namefold.plans import cluster

# Names whose clusters are known.
DEMO = [
    "john smith", "john smth", "jon smith", "john smith", "sarah connor", "sarah conner", "sara connor",
    "aviva insurance", "aviva ins", "avvia insurance", "direct line group", "direct line grp",
    "irwin mitchell", "irwn mitchell", "irwin mitchel",
]


def cleaned_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "cleaned_name string")


def random_names(count: int, seed: int) -> list[str]:
    """Names of few words, with typos, swapped words and shared words."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdehilnorst", k=rnd.randint(1, 8))) for _ in range(count // 3)]
    out = []
    for _ in range(count):
        name = [rnd.choice(words) for _ in range(rnd.randint(1, 3))] + rnd.choices([[], ["group"]], [2, 1])[0]
        out.append(" ".join(name))
        if rnd.random() < 0.4:
            rnd.shuffle(name)
            text = " ".join(name)
            at = rnd.randrange(len(text))
            out += [text, (text[:at] + text[at + 1 :]).strip() or "x"]
    return [" ".join(n.split()) for n in out]


def partition(rows, key="cluster_id"):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], set()).add(r["cleaned_name"])
    return {frozenset(g) for g in groups.values()}


def test_demo_with_default_threshold(spark, ws):
    rows = cluster.cluster_names(cleaned_frame(spark, DEMO), ws=ws).collect()
    assert partition(rows) == {
        frozenset({"john smith", "john smth", "jon smith"}),
        frozenset({"sarah connor", "sarah conner", "sara connor"}),
        frozenset({"aviva insurance", "aviva ins", "avvia insurance"}),
        frozenset({"direct line group", "direct line grp"}),
        frozenset({"irwin mitchell", "irwn mitchell", "irwin mitchel"}),
    }
    assert {r["representative_name"] for r in rows} == {
        "john smth", "sara connor", "aviva ins", "direct line grp", "irwin mitchel"
    }
    # Ids are dense and follow the representatives.
    ids = sorted({(r["representative_name"], r["cluster_id"]) for r in rows})
    assert [i for _, i in ids] == list(range(5))


def test_demo_with_low_threshold(spark, ws):
    rows = cluster.cluster_names(cleaned_frame(spark, DEMO), threshold=0.5, ws=ws).collect()
    assert frozenset({"avvia insurance"}) in partition(rows)
    assert frozenset({"aviva insurance", "aviva ins"}) in partition(rows)


def test_zero_override_means_default():
    cfg = ResolveConfig().with_precision(threshold=0, top_n=0)
    assert cfg.precision == ResolveConfig().precision


@pytest.mark.parametrize("seed", [1, 2])
def test_all_rounds_match_plain_version(spark, ws, seed):
    values = random_names(120, seed)
    rows = cluster.cluster_names(cleaned_frame(spark, values), ws=ws).collect()
    got = {r["cleaned_name"]: r["representative_name"] for r in rows}
    assert got == plain.representatives(values, ResolveConfig())


def cosine_pairs_by_full_index(weights, threshold: float):
    """The same pairs from the whole inverted index, the yardstick of the prefix join."""
    x = weights.select("gram_id", F.col("gid").alias("a"), F.col("w").alias("wa"))
    y = weights.select("gram_id", F.col("gid").alias("b"), F.col("w").alias("wb"))
    dots = (
        x.join(y, "gram_id")
        .filter(F.col("a") < F.col("b"))
        .groupBy("a", "b")
        .agg(F.round(F.sum(F.col("wa") * F.col("wb")), simjoin.DECIMALS).alias("sim"))
    )
    return dots.filter(F.col("sim") > threshold)


@pytest.mark.parametrize(
    "cfg",
    [
        ResolveConfig(),
        ResolveConfig(gram_block_rows=3),  # nearly every gram is split into blocks
        ResolveConfig(gram_block_rows=7, broadcast_bytes=0),  # and everything is joined by shuffles
    ],
    ids=["default", "blocks", "blocks-shuffled"],
)
@pytest.mark.parametrize("params", [ResolveConfig().precision, ResolveConfig().recall], ids=["strict", "loose"])
def test_join_equals_full_index(spark, ws, cfg, params):
    numbered, count = names.number_names(names.unique_cleaned_names(cleaned_frame(spark, random_names(200, 7))), ws)
    model = cluster.fit_model(numbered, count, params, cfg, ws)
    fast = simjoin.cosine_pairs(
        model.vectors, params.threshold, cfg, ws, model.grams.max_df, model.vector_bytes
    )
    slow = cosine_pairs_by_full_index(model.weights, params.threshold)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert fast.count() > 0


def test_own_name_takes_a_slot(spark, ws):
    values = ["abcdef one", "abcdef two", "abcdef six", "abcdef ten"]
    params = PassParams(0.1, (2, 4), 2, 60)
    numbered, count = names.number_names(cleaned_frame(spark, values), ws)
    # "abcdef" is in every name, so only more distinct names keep its grams in the model.
    model = cluster.fit_model(numbered, count, params, ResolveConfig(max_df=1.0), ws)
    ranked = cluster.neighbour_ranking(model, params, ResolveConfig(), ws)
    per_name = neighbours.topn_neighbours(ranked, model.members)
    assert {r["count"] for r in per_name.groupBy("src").count().collect()} == {1}


def test_names_of_equal_tokens_share_everything(spark, ws):
    """A group of copies in another word order: every name keeps the same ranked names."""
    words = ["alpha", "beta", "gamma", "delta"]
    rnd = random.Random(3)
    values = {" ".join(rnd.sample(words, 4)) for _ in range(60)} | {"alpha beta gamma", "unrelated", "zzz yyy"}
    params = ResolveConfig().recall
    numbered, count = names.number_names(names.unique_cleaned_names(cleaned_frame(spark, values)), ws)
    cfg = ResolveConfig()
    model = cluster.fit_model(numbered, count, params, cfg, ws)
    ranked = cluster.neighbour_ranking(model, params, cfg, ws)
    text = {r["id"]: r["cleaned_name"] for r in numbered.collect()}
    got = {
        (text[r["src"]], text[r["dst"]])
        for r in neighbours.topn_neighbours(ranked, model.members).collect()
    }
    ordered = sorted(values, key=lambda n: (len(n), n))
    sims = plain.similarities(ordered, params.threshold, *params.ngram_range)
    want = set()
    for i in range(len(ordered)):
        best = sorted((-s, j) for (a, j), s in sims.items() if a == i)[: params.top_n]
        want |= {(ordered[i], ordered[j]) for _, j in best if j != i}
    assert got == want
    rows = cluster.cluster_names(cleaned_frame(spark, values), ws=ws).collect()
    assert {r["cleaned_name"]: r["representative_name"] for r in rows} == plain.representatives(list(values), cfg)


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, ws, seed):
    rnd = random.Random(seed)
    count = 300
    edges = {tuple(sorted(rnd.sample(range(count), 2), reverse=True)) for _ in range(180)}
    edges |= {(i + 1, i) for i in range(200, 260)}  # a chain
    edges |= {(299, i) for i in range(0, 80)}  # a hub that is the largest id
    frame, _ = ws.save(spark.createDataFrame(list(edges), "u bigint, v bigint"), "edges")
    labels = components.connected_components(frame, ws)
    nodes = spark.range(count)
    got = {r["id"]: r["root"] for r in components.component_labels(nodes, labels).collect()}
    assert [got[i] for i in range(count)] == plain.roots(count, edges)


def test_local_forests_keep_components_and_thin_cliques(spark, ws):
    clique = [(i, j) for i in range(60) for j in range(i)]
    chain = [(i + 1, i) for i in range(100, 400)]
    frame, _ = ws.save(spark.createDataFrame(clique + chain, "u bigint, v bigint").repartition(3), "edges")
    forest = components.local_forests(frame).collect()
    assert len(forest) <= 3 * 59 + len(chain) and all(r.u > r.v for r in forest)  # a star per partition
    assert plain.roots(401, {tuple(r) for r in forest}) == plain.roots(401, set(clique + chain))
    labels = components.connected_components(frame, ws)
    got = {r["id"]: r["root"] for r in components.component_labels(spark.range(401), labels).collect()}
    assert [got[i] for i in range(401)] == plain.roots(401, set(clique + chain))


def skew_splits(df):
    """Joins that adaptive execution split when the query ran."""
    df.count()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("skew=true")


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def skewed(spark):
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    for k in SKEW:
        spark.conf.unset(k)


def test_hot_nodes_are_split(spark, ws, skewed):
    star, _ = ws.save(spark.range(1, 60_000).selectExpr("id as u", "cast(0 as bigint) as v").repartition(6), "edges")
    low, _ = ws.save(spark.sql(components._LOWEST, edges=star), "low")
    assert skew_splits(spark.sql(components._LARGE, edges=star, low=low)) >= 1
    hub, _ = ws.save(spark.range(60_000).selectExpr("cast(60000 as bigint) as u", "id as v").repartition(6), "hub")
    low, _ = ws.save(spark.sql(components._LOWEST, edges=hub), "low")
    assert skew_splits(spark.sql(components._SMALL, edges=hub, low=low)) >= 1


def test_hot_token_group_is_split(spark, ws, skewed):
    made = spark.range(40_000).selectExpr(
        "id", "concat('n', id) as cleaned_name", "if(id % 3 = 0, 'same tokens', concat('t', id)) as token_key"
    )
    numbered, _ = ws.save(made.repartition(6), "names")
    members, shared = names.token_groups(numbered, ws)
    assert shared == 13_334 and members.filter("gid <> id").count() == 13_333
    groups = spark.createDataFrame([("same tokens", 0, 13_334)], "token_key string, gid bigint, size bigint")
    plain, _ = ws.save(groups, "groups")
    assert skew_splits(numbered.join(plain, "token_key", "left")) >= 1


def test_component_stats_without_edges(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "id bigint, root bigint")
    stats = components.size_stats(rows).first().asDict()
    assert stats == {
        "clusters": 2, "singletons": 2, "multi_member_clusters": 0, "avg_multi_size": None, "max_size": None
    }


@pytest.mark.parametrize(
    "values",
    [[], [""], ["  ", None], ["only one"], ["ab ba", "ba ab"], ["same x", "same x", "x same", "q"]],
    ids=["empty", "blank", "null", "one", "all-pruned", "copies"],
)
def test_degenerate_inputs(spark, ws, values):
    rows = cluster.cluster_names(cleaned_frame(spark, values), ws=ws).collect()
    distinct = {v for v in values if v and v.strip()}
    assert {r["cleaned_name"] for r in rows} == distinct
    if values == ["ab ba", "ba ab"]:  # every gram is in every name, so nothing is similar
        assert len({r["cluster_id"] for r in rows}) == 2
    if distinct:
        assert min(r["cluster_id"] for r in rows) == 0


@pytest.mark.parametrize("broadcast_bytes", [0, 64 * 30, 1 << 20], ids=["shuffled", "split", "broadcast"])
def test_idf_and_cut_match_plain_version(spark, ws, broadcast_bytes):
    values = sorted(set(random_names(40, 5)))
    numbered, count = names.number_names(cleaned_frame(spark, values), ws)
    single = numbered.select(F.col("id").alias("gid"), F.lit(1).cast("bigint").alias("size"), "cleaned_name")
    terms = features.term_counts(single, count, (2, 4))
    model = features.fit(terms, count, 0.3, ws)
    weights = features.weighted_terms(terms, model, broadcast_bytes)
    got = {(r["cleaned_name"], r["gram"]): r["w"] for r in weights.join(numbered, F.col("gid") == F.col("id")).collect()}
    want = {(n, g): w for n, v in zip(values, plain.vectors(values, 2, 4, 0.3)) for g, w in v.items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    ids = [(r["gram_id"], r["df"], r["gram"]) for r in model.table.collect()]
    assert [x[1:] for x in sorted(ids)] == sorted(x[1:] for x in ids)


def test_rounds_only_refine_then_coarsen(spark, ws):
    values = random_names(150, 11)
    results = cluster.run_rounds(cleaned_frame(spark, values), replace(ResolveConfig()), ws)
    first = results[0].labels.collect()
    roots = {}
    for r in first:
        roots.setdefault(r["label"], set()).add(r["root"])
    assert all(len(v) == 1 for v in roots.values())  # verification only refines
    by_label = Counter(r["label"] for r in first)
    later = {r["id"] for r in results[1].labels.collect()}
    assert later == set(by_label)  # the next round holds exactly the representatives
    final = cluster.clusters_of(results, ws).collect()
    members = {}
    for r in final:
        members.setdefault(r["cluster_id"], []).append(r)
    for rows in members.values():
        best = min((r["cleaned_name"] for r in rows), key=lambda n: (len(n), n))
        assert {r["representative_name"] for r in rows} == {best}
