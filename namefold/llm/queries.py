"""The dealt operators as queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namefold.llm import (
    alignment, decontam, divergence, licenses, mixing, multiset, quality, secret_forest, simhash, substring, token_orc, toxicity, urls,
)
from namefold.llm.oracles import ORACLES  # noqa: F401
from namefold.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Workspace(spark).path}/tokens"
    token_orc.write(table(spark, sf_dir, "documents"), path, op_vocabulary())
    return token_orc.digests(spark, path)


def op3_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = ~quality.held_out(F.col("doc_id"))
    return quality.predicted(docs, quality.fit(docs, table(spark, sf_dir, "labels"), learned))


def op4_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.compared(table(spark, sf_dir, "documents"))


def op5_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(table(spark, sf_dir, "documents"), Workspace(spark))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_takes(table(spark, sf_dir, "documents"), Workspace(spark))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return decontam.reports(table(spark, sf_dir, "documents"), items, Workspace(spark))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), simhash.EXACT, Workspace(spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), Workspace(spark))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"), Workspace(spark))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), Workspace(spark))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_orc": op2_token_orc,
    "op3_subword_quality": op3_subword_quality,
    "op4_multiset_hash": op4_multiset_hash,
    "op5_secret_forest": op5_secret_forest,
    "op6_source_mixing": op6_source_mixing,
    "op7_winnowing": op7_winnowing,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_license_rules": op10_license_rules,
    "op11_source_divergence": op11_source_divergence,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": pipeline,
}
