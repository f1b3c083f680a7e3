"""Parquet layers: partitioned writes that survive re-runs and skew, and scans that prune."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

STATION_MONTH = ("station_id", "year", "month")
#: Station-months that may be broadcast: some 10 MB.
MOST_MONTHS = 100_000


def write_partitioned(
    df: DataFrame, folder: str, keys: Sequence[str] = STATION_MONTH, mode: str = "overwrite", whole: bool = False,
) -> None:
    """Write Parquet (Snappy) with one folder per key.

    The rebalance hint brings the rows of a key together so that files are few, and lets adaptive
    execution cut a key that holds far too many rows into several tasks.  ``overwrite`` replaces only
    the folders the rows belong to, which makes a full re-run idempotent, or with ``whole`` all of them; a delivery with
    part of a month is to be appended (the typed layer removes duplicates).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    (
        df.hint("rebalance", *keys).write.mode(mode).option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy").partitionBy(*keys).parquet(folder)
    )


def partition_counts(df: DataFrame, entity: str = "station_id") -> DataFrame:
    """Number of year-month partitions per entity."""
    return df.select(entity, "year", "month").distinct().groupBy(entity).agg(F.count("*").alias("n_partitions"))


def read_layer(
    spark: SparkSession, folder: str, start: dt.date | None = None, end: dt.date | None = None,
    stations: Sequence[str] | None = None, ts: str = "observation_ts", lines: bool = False,
) -> DataFrame:
    """Scan a partitioned layer; a time range also prunes the year and month folders.

    Lines of the exports that are no rows, which the bronze layer keeps too, are given only with ``lines``.
    """
    df = spark.read.parquet(folder)
    if df.schema["station_id"].dataType != T.StringType():
        # Folder names that look like numbers would lose leading zeros.
        text = [T.StructField(f.name, T.StringType()) if f.name == "station_id" else f for f in df.schema.fields]
        df = spark.read.schema(T.StructType(text)).parquet(folder)
    if "line" in df.columns and not lines:
        df = df.filter(F.col("line").isNull()).drop("line", "place")
    month_key = F.col("year") * 100 + F.col("month")
    if start is not None:
        df = df.filter((F.col("year") >= start.year) & (month_key >= start.year * 100 + start.month))
        if ts in df.columns:
            df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter((F.col("year") <= end.year) & (month_key <= end.year * 100 + end.month))
        if ts in df.columns:
            df = df.filter(F.col(ts) < F.date_add(F.lit(end), 1).cast("timestamp_ntz"))
    return only(df, "station_id", stations)


def months_of(df: DataFrame) -> DataFrame:
    """The station-months that the rows belong to."""
    return df.filter(F.col("year").isNotNull()).select(*STATION_MONTH).distinct()


def read_months(spark: SparkSession, folder: str, months: DataFrame | None) -> DataFrame:
    """The rows of some station-months of a partitioned layer (``None``: of all); folders of others are not opened.

    The months are a table, joined on the folder names. Up to ``MOST_MONTHS`` of them are broadcast, after which Spark opens their
    folders only; beyond that the rows of all folders are compared.
    """
    df = read_layer(spark, folder)
    if months is None:
        return df
    wanted = months.filter(F.col("year") > 0)  # Spark prunes by a side that has a condition
    if months.limit(MOST_MONTHS + 1).count() <= MOST_MONTHS:
        wanted = F.broadcast(wanted)
    return df.join(wanted, list(STATION_MONTH), "left_semi")


def write_fact(df: DataFrame, folder: str, name: str, part: bool = False) -> DataFrame:
    """Write a fact by station, year and month of ``date_local``, all of it or the months that ``df`` holds (``part``); read it back.

    The fact read back has the columns of ``df``; the folders also know ``year`` and ``month``.
    """
    path = f"{folder.rstrip('/')}/{name}"
    keyed = df if "year" in df.columns else df.withColumns({"year": F.year("date_local"), "month": F.month("date_local")})
    write_partitioned(keyed, path, whole=not part)
    return read_layer(df.sparkSession, path).select(*df.columns)


def only(df: DataFrame, key: str, ids: Sequence[str] | None) -> DataFrame:
    """Keep the listed entities; ``None`` keeps all."""
    return df if ids is None else df.filter(F.col(key).isin(list(ids)))


def write_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Replace one table of the star schema and read it back."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a frame queryable by name in SQL."""
    df.createOrReplaceTempView(name)
    return df


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and number of rows of each table, as one plan."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
