"""Typing, cleaning and flagging of observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions.clock import parse_export_stamp
from obslake.operators.dedup import OBSERVATION_KEY, keep_first, latest_delivery
from obslake.schema import QUALITY_BOUNDS, RAW_COLUMNS, RAW_TO_TYPED

LINEAGE = ("ingestion_ts", "source_file")


def _typed(raw: str, kind: str) -> Column:
    text = F.col(f"`{raw}`").cast("string")
    if kind == "double":
        return text.try_cast("double")
    if kind == "int":
        # Text such as '2.5' counts as a number and rounds half up.
        return F.coalesce(text.try_cast("int"), F.round(text.try_cast("double")).try_cast("int"))
    return text


def type_rows(bronze: DataFrame, keep: Sequence[str] = LINEAGE) -> DataFrame:
    """Rename and type the export columns that are present; rows without a valid instant leave."""
    known = set(bronze.columns)
    columns = [_typed(raw, kind).alias(typed) for raw, typed, kind, _ in RAW_TO_TYPED if raw in known]
    extra = [c for c in keep if c in known]
    stamp = parse_export_stamp("Date", "Time")
    # A bronze row without a valid instant has no year, which also prunes its folder.
    valid = F.col("year").isNotNull() if "year" in known else stamp.isNotNull()
    return (
        bronze.filter(F.col("Date").isNotNull() & F.col("Time").isNotNull() & valid)
        .select("station_id", stamp.alias("observation_ts"), *columns, *extra)
    )


def quality_flag(bounds=None, present: Sequence[str] | None = None) -> Column:
    """Name of the first reading outside its range, NULL when all are plausible or missing."""
    flag = F.lit(None).cast("string")
    for name, lo, hi, label in reversed(bounds or QUALITY_BOUNDS):
        if present is None or name in present:
            flag = F.when((F.col(name) < lo) | (F.col(name) > hi), F.lit(label)).otherwise(flag)
    return flag


def flag_rows(df: DataFrame, bounds=None) -> DataFrame:
    """Mark suspicious rows instead of dropping them, and add the parts of the instant."""
    ts = F.col("observation_ts")
    return df.withColumns({
        "quality_flag": quality_flag(bounds, df.columns),
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
    })


def silver(bronze: DataFrame) -> DataFrame:
    """The typed layer: one flagged row per station and instant, 45 columns."""
    content = [typed for raw, typed, _, _ in RAW_TO_TYPED if raw in set(bronze.columns)]
    typed = type_rows(bronze)
    unique = keep_first(typed, latest_delivery(typed, content), OBSERVATION_KEY)
    return flag_rows(unique.drop(*LINEAGE))


def profile(df: DataFrame) -> DataFrame:
    """Rows, first and last instant and flagged rows per station."""
    return df.groupBy("station_id").agg(
        F.count("*").alias("n_rows"), F.min("observation_ts").alias("first_ts"),
        F.max("observation_ts").alias("last_ts"), F.count("quality_flag").alias("flagged"),
    ).orderBy("station_id")


def profile_totals(df: DataFrame) -> DataFrame:
    """Rows, flagged rows and their share in percent."""
    totals = df.agg(F.count("*").alias("n_rows"), F.count("quality_flag").alias("flagged"))
    share = F.try_divide(F.col("flagged").cast("decimal(20,0)") * 100, F.col("n_rows").cast("decimal(20,0)"))
    return totals.withColumn("flagged_pct", F.round(share, 2).cast("double"))


assert len(RAW_COLUMNS) == 38
