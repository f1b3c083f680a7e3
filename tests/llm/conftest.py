import os
import sys

import pytest
from pyspark.sql import functions as F, types as T

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", ".."))

from obslake.session import ship_package  # noqa: E402

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with extra columns whose names the operators use themselves."""

    def make(rows):
        df = spark.createDataFrame(list(rows), DOCS)
        clashing = ("n_words", "score", "component_id", "component", "class", "n", "uid", "word", "length", "kept", "h", "carried_0")
        return df.withColumns({c: F.lit("x") for c in clashing})

    return make


@pytest.fixture(scope="session")
def some_docs(spark, sf):
    """The whole small table, with rows that are awkward: null, empty, short, repeated, long, odd characters."""
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, "one two"), (900_004, "one two"), (900_005, "ONE two"),
           (900_006, "a b c d e " * 4_000), (900_007, "x" * 70_000), (900_008, "café ñandú <|endoftext|> 日本   \x85 \x1c 😀"),
           (None, "no id at all")]
    return table.union(spark.createDataFrame(odd, DOCS))
