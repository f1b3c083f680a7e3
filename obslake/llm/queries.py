"""The corpus queries by name; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm import (
    bpe, class_lm, embedding_dedup, html_wrappers, license_scan, nbsvm, ngram_join, packing, phrase_mining, quality_rules, token_alignment, toxicity,
    vantage_search,
)
from obslake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies, the byte-level one by default; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, d, "documents")).drop("spans")


def op2_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.link_components(table(spark, d, "documents"))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(table(spark, d, "documents")).drop("n_words_left")


def op4_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), vocabulary())


def op5_html_wrappers(spark: SparkSession, d: str) -> DataFrame:
    return html_wrappers.extract(table(spark, d, "pages"))


def op6_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip(table(spark, d, "documents"), vocabulary())


def op7_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return nbsvm.score(docs, nbsvm.train(docs, table(spark, d, "labels")))


def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, d, "labels"))).drop("spans")


def op9_class_lm(spark: SparkSession, d: str) -> DataFrame:
    return class_lm.score(table(spark, d, "documents"))


def op10_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, d, "embeddings"))


def op11_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    return token_alignment.digest(table(spark, d, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op12_vantage_search(spark: SparkSession, d: str) -> DataFrame:
    found = vantage_search.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.withColumn("rank", F.col("rank").cast("int"))


def op13_phrase_mining(spark: SparkSession, d: str) -> DataFrame:
    return phrase_mining.mine(table(spark, d, "documents")).withColumn("rank", F.col("rank").cast("long"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_license_scan, op2_ngram_join, op3_quality_rules, op4_best_fit_packing, op5_html_wrappers, op6_bpe, op7_quality_classifier, op8_toxicity, op9_class_lm,
    op10_embedding_dedup, op11_token_alignment, op12_vantage_search, op13_phrase_mining)}
