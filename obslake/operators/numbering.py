"""Global row numbers and ranks without a single-task window.

A window without partition keys moves every row into one task, and so does one partitioned by a key that
holds most rows.  Here the rows are range-partitioned on the full sort key (which splits hot keys, since
the key is unique), sorted locally, and numbered by position; the offsets come from one count per
partition.  The boundaries are sampled, so the sorted rows are materialised once in the shared folder
and both uses read that copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Number the rows from 1 in ``order``, which has to be a total order."""
    ranged = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    slot = F.shiftright("_at", _POSITION_BITS).alias("_slot")
    counts = ranged.groupBy(slot).agg(F.count("*").alias("_n"))
    # One row per partition, so this window is bounded by the number of tasks.
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        ranged.withColumn("_slot", slot).join(F.broadcast(offsets), "_slot")
        .select(*df.columns, (F.col("_before") + position + 1).alias(name))
    )


def dense_rank_desc(df: DataFrame, context: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Dense rank of ``value``, highest first, within each context; ``value`` must not be NULL."""
    keys = list(context)
    distinct = df.select(*keys, value).distinct()
    numbered = global_row_number(distinct, [*[F.col(k).asc() for k in keys], F.col(value).desc()], "_rn")
    if keys:
        first = numbered.groupBy(*keys).agg(F.min("_rn").alias("_first"))
        numbered = numbered.join(first, keys).withColumn("_rn", F.col("_rn") - F.col("_first") + 1).drop("_first")
    return df.join(numbered.withColumnRenamed("_rn", name), [*keys, value])


def top_with_ties(df: DataFrame, context: Sequence[str], value: str) -> DataFrame:
    """The rows holding the highest non-NULL ``value`` of their context, ties included.

    The rank filter is planned as a group limit on both sides of the shuffle: a task sends only the rows
    that lead a context among its own.
    """
    keys, valued = list(context), df.filter(F.col(value).isNotNull())
    if not keys:
        best = valued.agg(F.max(value)).scalar()
        return valued.filter(F.col(value) == best)
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return valued.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")
