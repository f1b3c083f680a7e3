"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# The instant first: sorts compare its 64 bits before they look at any text.
OBSERVATION_KEY = ("observation_ts", "station_id")


def keep_first(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = OBSERVATION_KEY) -> DataFrame:
    """The first row of every key in ``order``.

    Spark plans the rank filter as a group limit before and after the shuffle, so a key with a very
    large number of copies leaves each map task as a single row.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def latest_delivery(df: DataFrame, content: Sequence[str]) -> list[Column]:
    """Tie-break of the typed layer: newest ingestion, then file name, its whole path if known, then the content itself."""
    escaped = [F.col(f"`{c}`") for c in content]
    path = [F.col("source_path").desc_nulls_last()] if "source_path" in df.columns else []
    return [F.col("ingestion_ts").desc_nulls_last(), F.col("source_file").desc_nulls_last(), *path, F.xxhash64(*escaped).asc()]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty for a valid primary key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
