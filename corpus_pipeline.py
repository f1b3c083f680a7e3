"""A corpus pipeline of four operators: documents of poor quality go, one of each group of near copies stays, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder and reads it again for the
next stage. All but the last return the columns of ``docs``, rows unchanged. A stage's folder goes when the next one is written.

Null and empty texts, and all of fewer than 50 words, end at the quality rules. Of repeated rows one stays, as of any group of near copies
(different texts that share an id, or have none, are different documents). Extra columns pass through to the packing, which leaves
them behind. An empty table gives no rows; without labels the classifier rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obslake.llm import nbsvm, ngram_join, packing, quality_rules
from obslake.llm.common import remove, table
from obslake.llm.queries import vocabulary
from obslake.session import new_shared_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nbsvm.keep(docs, nbsvm.train(docs, table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rules), ("ngram_join", near_copies),
          ("best_fit_packing", best_fit_packing)]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
