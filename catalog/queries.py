"""Every operator as a query over the given tables.

Queries that only report on a stage share the stage's written tables within a session; the end-to-end
queries always run everything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.fixtures import hard_rows, payee_names, payee_rows
from namefold.config import ResolveConfig
from namefold.functions import cleaning, fuzzy
from namefold.operators import components, features, names, neighbours, simjoin, verify
from namefold.plans import cluster, profiles, resolve, run
from namefold.sources import files
from namefold.workspace import Workspace

NAME = "payee_name"
Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Stages:
    """Stages of the resolution of one data set, written when first asked for."""

    spark: SparkSession
    sf_dir: str
    cfg: ResolveConfig = field(default_factory=ResolveConfig)

    @cached_property
    def ws(self) -> Workspace:
        return Workspace(self.spark)

    @property
    def rows(self) -> DataFrame:
        return payee_rows(self.spark, self.sf_dir)

    @cached_property
    def cleaned(self) -> DataFrame:
        return self.ws.save(names.cleaning_map(self.rows, NAME), "cleaned")[0]

    @cached_property
    def numbered(self) -> tuple[DataFrame, int]:
        return names.number_names(names.unique_cleaned_names(self.cleaned), self.ws)

    @cached_property
    def single(self) -> DataFrame:
        """Each name as a group of its own, for the operators that are shown per name."""
        return self.numbered[0].select(F.col("id").alias("gid"), F.lit(1).cast("bigint").alias("size"), "cleaned_name")

    @cached_property
    def terms(self) -> DataFrame:
        return features.term_counts(self.single, self.numbered[1], self.cfg.precision.ngram_range)

    @cached_property
    def grams(self) -> features.GramModel:
        return features.fit(self.terms, self.numbered[1], self.cfg.max_df, self.ws)

    @cached_property
    def loose(self) -> cluster.Model:
        """Vectors of all names with the recall settings: more pairs and larger components."""
        return cluster.fit_model(*self.numbered, self.cfg.recall, self.cfg, self.ws)

    @cached_property
    def loose_pairs(self) -> DataFrame:
        pairs = simjoin.cosine_pairs(
            self.loose.vectors,
            self.cfg.recall.threshold,
            self.cfg,
            self.ws,
            self.loose.grams.max_df,
            self.loose.vector_bytes,
        )
        return self.ws.save(pairs, "pairs")[0]

    @cached_property
    def loose_ranking(self) -> DataFrame:
        m = self.loose
        ranked = neighbours.ranked_neighbours(
            self.loose_pairs, m.vectors, m.members, self.cfg.recall.top_n, m.shared
        )
        return self.ws.save(ranked, "ranking")[0]

    @cached_property
    def loose_neighbours(self) -> DataFrame:
        return neighbours.topn_neighbours(self.loose_ranking, self.loose.members)

    @cached_property
    def loose_linked(self) -> DataFrame:
        edges, _ = self.ws.save(neighbours.group_edges(self.loose_ranking), "edges")
        return components.connected_components(edges, self.ws)

    @cached_property
    def rounds(self) -> list[cluster.PassResult]:
        return cluster.run_rounds(self.cleaned, self.cfg, self.ws)

    @cached_property
    def clusters(self) -> DataFrame:
        return self.ws.save(cluster.clusters_of(self.rounds, self.ws), "clusters")[0]

    @cached_property
    def mapping(self) -> DataFrame:
        return self.ws.save(resolve.mapping_table(self.cleaned, self.clusters), "mapping")[0]

    @property
    def final(self) -> DataFrame:
        return resolve.merge_back(self.rows, self.mapping, NAME, self.cfg.broadcast_bytes)

    def text_of(self, df: DataFrame, **renames: str) -> DataFrame:
        """Replace id columns by names: ``id_column="output_column"``."""
        texts = self.numbered[0].select("id", "cleaned_name")
        for column, output in renames.items():
            found = texts.select(F.col("id").alias(column), F.col("cleaned_name").alias(output))
            df = df.join(found, column).drop(column)
        return df


_stages: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stages(spark, sf_dir)
    return _stages[key]


def _staged(build: Callable[[Stages], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stages(spark, sf_dir))


def _step(step) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        originals = names.unique_names(payee_rows(spark, sf_dir), NAME)
        return originals.select("original_name", step(F.col("original_name")).alias("result"))

    return query


def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with line breaks, quotes, blanks and missing-value texts, written and read as CSV."""
    rows = hard_rows(spark, sf_dir)
    path = f"{Workspace(spark).path}/csv"
    files.write_dataset(rows, path, "csv")
    return files.read_csv(spark, path, NAME, rows.schema)


def table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_table(spark, f"{sf_dir}/part.parquet")


def clean_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = payee_names(spark, sf_dir)
    blanks = F.when(F.col("p_partkey") % 12 == 0, F.repeat(F.lit(" "), (F.col("p_partkey") % 5).cast("int")))
    return found.select("p_partkey", cleaning.null_safe(F.coalesce(blanks, F.col(NAME))).alias("result"))


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = payee_names(spark, sf_dir)
    return found.select("p_partkey", cleaning.clean_name(F.col(NAME)).alias("cleaned_name"))


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payee_rows(spark, sf_dir).filter(F.col(NAME).isNotNull())
    rows = rows.select(F.col(NAME).alias("original_name"))
    return names.one_per_key(rows, "original_name").withColumn(
        "cleaned_name", cleaning.clean_name(F.col("original_name"))
    )


def term_freq(s: Stages) -> DataFrame:
    counts = s.terms.select("gid", "gram", "tf", F.round(features.sublinear_tf(F.col("tf")), 6).alias("sublinear_tf"))
    return s.text_of(counts, gid="cleaned_name")


def doc_freq_idf(s: Stages) -> DataFrame:
    idf = features.smooth_idf(F.col("df"), s.grams.documents)
    return s.grams.table.select("gram", "df", F.round(idf, 6).alias("idf"))


def _weights(s: Stages) -> DataFrame:
    return features.weighted_terms(s.terms, s.grams, s.cfg.broadcast_bytes)


def tfidf_weights(s: Stages) -> DataFrame:
    return s.text_of(_weights(s).select("gid", "gram", F.round("w", 6).alias("weight")), gid="cleaned_name")


def tfidf_stats(s: Stages) -> DataFrame:
    stats = profiles.tfidf_stats(_weights(s), s.numbered[1])
    return stats.withColumn("density", F.round("density", 9))


def cosine_pairs(s: Stages) -> DataFrame:
    """Names with their first neighbours above the threshold; a pair is there if either side kept the other."""
    found = s.loose_neighbours.select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.round("sim", 6).alias("cosine")
    )
    return s.text_of(found.distinct(), a="name_a", b="name_b")


def topn_neighbours(s: Stages) -> DataFrame:
    found = s.loose_neighbours.select("src", "dst", F.round("sim", 6).alias("cosine"))
    return s.text_of(found, src="name", dst="neighbour")


def symmetric_edges(s: Stages) -> DataFrame:
    return s.text_of(neighbours.symmetric_edges(s.loose_neighbours), v="name_a", u="name_b")


def _loose_components(s: Stages) -> DataFrame:
    return components.component_labels(s.loose.members, s.loose_linked, "gid").select("id", "root")


def connected_components(s: Stages) -> DataFrame:
    return s.text_of(_loose_components(s), id="cleaned_name", root="component")


def cluster_size_stats(s: Stages) -> DataFrame:
    stats = components.size_stats(s.rounds[0].labels)
    return stats.withColumn("avg_multi_size", F.round("avg_multi_size", 6))


def token_sort_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    plain = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("name_b"))
    spellings = payee_names(spark, sf_dir).filter(F.col(NAME).isNotNull()).join(plain, "p_partkey")
    pairs = spellings.select(F.col(NAME).alias("name_a"), "name_b").distinct()
    score = fuzzy.token_sort_ratio(F.col("name_a"), F.col("name_b"))
    return pairs.select("name_a", "name_b", F.round(score, 6).alias("score"))


def cluster_anchor(s: Stages) -> DataFrame:
    """The anchor of every component of the first round: its smallest id, in the engine's own order."""
    labels = s.rounds[0].labels
    sizes = labels.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    return s.text_of(sizes, root="anchor")


def split_weak_members(s: Stages) -> DataFrame:
    verdicts = verify.anchor_verdicts(s.loose_linked, s.loose.members, s.cfg.recall.fuzz)
    labels = verify.split_weak_members(s.loose.members, verdicts)
    return s.text_of(labels.drop("id", "token_key"), root="anchor", label="cluster")


def select_representatives(s: Stages) -> DataFrame:
    labels = s.rounds[0].labels
    best = verify.representatives(labels, "cleaned_name", "label")
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    return best.join(sizes, "label").drop("label")


def attach_representative(s: Stages) -> DataFrame:
    labels = s.rounds[0].labels.select("cleaned_name", "label")
    return verify.attach_representatives(labels, "cleaned_name", "label").drop("label")


def compose_labels(s: Stages) -> DataFrame:
    composed = cluster.compose_labels(s.rounds[0].labels, s.rounds[1].labels)
    return s.text_of(composed.select("cleaned_name", "label"), label="representative_name")


def pass1_precision(s: Stages) -> DataFrame:
    return s.text_of(s.rounds[0].labels.select("cleaned_name", "root"), root="component")


def pass2_verify(s: Stages) -> DataFrame:
    return s.text_of(s.rounds[0].labels.select("cleaned_name", "label"), label="representative_name")


def _later_pass(number: int) -> Callable[[Stages], DataFrame]:
    def query(s: Stages) -> DataFrame:
        labels = s.rounds[number].labels.select("cleaned_name", "root", "label")
        return s.text_of(labels, root="component", label="representative_name")

    return query


def cluster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    cleaned, _ = ws.save(names.cleaning_map(payee_rows(spark, sf_dir), NAME), "cleaned")
    return cluster.cluster_names(cleaned, ws=ws)


def cluster_names_overridden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first round as loose as the recall round; a falsy override keeps the default."""
    ws = Workspace(spark)
    cleaned, _ = ws.save(names.cleaning_map(payee_rows(spark, sf_dir), NAME), "cleaned")
    return cluster.cluster_names(cleaned, threshold=0.60, ngram_range=(2, 4), top_n=0, ws=ws)


def resolve_payees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a written source to written results."""
    ws = Workspace(spark)
    source = f"{ws.path}/rows"
    payee_rows(spark, sf_dir).write.parquet(source)
    return run.run(spark, source, f"{ws.path}/results", NAME).final


def mapping_csv_sink(s: Stages) -> DataFrame:
    path = f"{s.ws.path}/mapping-{uuid4().hex}"
    files.write_mapping_csv(s.mapping, path)
    return files.read_mapping_csv(s.spark, path)


def dataset_sink(s: Stages) -> DataFrame:
    path = f"{s.ws.path}/final-{uuid4().hex}"
    files.write_dataset(s.final, path)
    return files.read_table(s.spark, path)


def table_sinks(s: Stages) -> DataFrame:
    """The rows of both tables as they are read back; the catalog entries are dropped, the files are the workspace's."""
    tag = uuid4().hex
    tables = {"mapping": f"mapping_{tag}", "final": f"final_{tag}"}
    files.write_tables(s.mapping, s.final, tables["mapping"], tables["final"], location=s.ws.path)
    found = {}
    for label, table in tables.items():
        stored = files.read_table(s.spark, table)
        path = s.spark.sql(f"describe extended {table}").filter("col_name = 'Location'").first()["data_type"]
        found[label] = s.spark.read.schema(stored.schema).format("parquet").load(path)
        s.spark.sql(f"drop table {table}")
    keys = ["cleaned_name", "cluster_id", "representative_name"]
    final = found["final"].select(F.lit("final").alias("written"), F.col(NAME).alias("original_name"), *keys)
    return found["mapping"].select(F.lit("mapping").alias("written"), "original_name", *keys).unionByName(final)


def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profiles.source_profile(payee_rows(spark, sf_dir), NAME)
    return profile.withColumn("reduction_pct", F.round("reduction_pct", 6))


def cleaning_profile(s: Stages) -> DataFrame:
    return profiles.cleaning_profile(s.cleaned).withColumn("modified_pct", F.round("modified_pct", 6))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "csv_source": csv_source,
    "table_source": table_source,
    "mapping_csv_sink": _staged(mapping_csv_sink),
    "dataset_sink": _staged(dataset_sink),
    "table_sinks": _staged(table_sinks),
    # distinct names
    "unique_names": lambda spark, sf: names.unique_names(payee_rows(spark, sf), NAME),
    "unique_cleaned_names": _staged(lambda s: names.unique_cleaned_names(s.cleaned)),
    "dedupe_by_key": dedupe_by_key,
    # cleaning
    "clean_null_safe": clean_null_safe,
    "clean_dates": _step(cleaning.drop_dates),
    "clean_prefixes": _step(cleaning.drop_prefixes),
    "clean_junk_words": _step(cleaning.drop_junk_words),
    "clean_brackets": _step(cleaning.drop_brackets),
    "clean_digits": _step(cleaning.drop_digits),
    "clean_edge_noise": _step(cleaning.trim_edge_noise),
    "clean_standardize": _step(cleaning.standardize),
    "clean_names": clean_names,
    "cleaning_map": lambda spark, sf: names.cleaning_map(payee_rows(spark, sf), NAME),
    # text features
    "char_wb_ngrams": _staged(
        lambda s: s.text_of(
            features.name_grams(s.single, s.cfg.precision.ngram_range).drop("size"), gid="cleaned_name"
        )
    ),
    "term_freq": _staged(term_freq),
    "doc_freq_idf": _staged(doc_freq_idf),
    "tfidf_weights": _staged(tfidf_weights),
    "tfidf_stats": _staged(tfidf_stats),
    # similarity graph
    "cosine_pairs": _staged(cosine_pairs),
    "topn_neighbours": _staged(topn_neighbours),
    "symmetric_edges": _staged(symmetric_edges),
    "connected_components": _staged(connected_components),
    "cluster_size_stats": _staged(cluster_size_stats),
    # verification and representatives
    "token_sort_ratio": token_sort_ratio,
    "cluster_anchor": _staged(cluster_anchor),
    "split_weak_members": _staged(split_weak_members),
    "select_representatives": _staged(select_representatives),
    "attach_representative": _staged(attach_representative),
    "compose_labels": _staged(compose_labels),
    # rounds and end to end
    "pass1_precision": _staged(pass1_precision),
    "pass2_verify": _staged(pass2_verify),
    "pass3_recall": _staged(_later_pass(1)),
    "pass4_merge": _staged(_later_pass(2)),
    "cluster_names": cluster_names,
    "cluster_names_overridden": cluster_names_overridden,
    "attach_clusters": _staged(lambda s: resolve.attach_clusters(s.cleaned, s.clusters)),
    "mapping_table": _staged(lambda s: resolve.mapping_table(s.cleaned, s.clusters)),
    "merge_back": _staged(lambda s: s.final),
    "resolve_payees": resolve_payees,
    # reports
    "largest_clusters": _staged(lambda s: resolve.largest_clusters(s.mapping)),
    "browse_mapping": _staged(lambda s: resolve.browse_mapping(s.mapping)),
    "source_profile": source_profile,
    "cleaning_profile": _staged(cleaning_profile),
    "mapping_profile": _staged(lambda s: profiles.mapping_profile(s.mapping)),
    "pass_summary": _staged(lambda s: profiles.pass_summary(s.rounds)),
    "run_summary": _staged(lambda s: profiles.run_summary(s.rows, s.mapping, s.final)),
}
