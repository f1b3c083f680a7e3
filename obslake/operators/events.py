"""Extreme events, their ids, and event-window weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.functions.clock import day_fraction
from obslake.functions.exact import col
from obslake.operators.numbering import global_row_number
from obslake.schema import EVENT_RULES, EVENT_WINDOWS, RAMP_DAYS, WINDOW_SCHEMA, EventRule
from obslake.session import literal_rows

EVENT_ORDER = ("date_local", "station_id", "event_type")


def detect_events(daily: DataFrame, rules: Sequence[EventRule] = EVENT_RULES) -> DataFrame:
    """A row for every rule a day breaks, in one pass over the daily rows."""
    hits = []
    for rule in rules:
        value = F.col(rule.metric)
        if rule.op not in (">", "<"):
            raise ValueError("an event rule compares with '>' or '<'")
        beyond = value > rule.threshold if rule.op == ">" else value < rule.threshold
        hits.append(F.struct(
            F.coalesce(beyond, F.lit(False)).alias("hit"), F.lit(rule.event_type).alias("event_type"),
            (value if rule.op == ">" else F.abs(value)).cast("double").alias("magnitude"),
            F.lit(rule.metric).alias("metric"), F.lit(rule.description).alias("description"),
        ))
    broken = F.filter(F.array(*hits), lambda h: h.hit)
    return daily.select("station_id", "date_local", F.inline(broken)).drop("hit")


def extreme_events(daily: DataFrame, rules: Sequence[EventRule] = EVENT_RULES) -> DataFrame:
    """Events numbered from 1 by date, station and type."""
    numbered = global_row_number(detect_events(daily, rules), EVENT_ORDER, "event_id")
    return numbered.select("event_id", *[c for c in numbered.columns if c != "event_id"])


def event_windows(spark: SparkSession, rows=EVENT_WINDOWS) -> DataFrame:
    return literal_rows(spark, rows, WINDOW_SCHEMA)


def window_days(windows: DataFrame, ramp_days: int = RAMP_DAYS) -> DataFrame:
    """The summed anomalies of every day some window reaches, as ``level + slope * share of the day``.

    A window's weight is 1 between its ends and ramps linearly over ``ramp_days`` before and after (its
    end is a midnight, so the last day already ramps down).  Within any one day that is a straight line,
    and so is the sum over overlapping windows: six numbers per day hold all there is to know.
    """
    if ramp_days < 1:
        raise ValueError("ramp_days must be at least 1")
    reach = F.sequence(F.date_sub("start", ramp_days), F.date_add("end", ramp_days - 1))
    days = windows.withColumn("_day", F.explode(reach))
    before, after = F.datediff("start", "_day"), F.datediff("_day", "end")
    days = days.withColumns({
        "_level": F.when(before > 0, 1.0 - before / F.lit(float(ramp_days)))
                   .when(after > 0, 1.0 - after / F.lit(float(ramp_days))).otherwise(1.0),
        "_slope": F.when(before > 0, 1.0 / ramp_days).when(after >= 0, -1.0 / ramp_days).otherwise(0.0),
    })
    effects = {
        "temp_anomaly": F.col("temp_anomaly_c"), "humidity_anomaly": F.col("humidity_anomaly_pct"),
        "precip_multiplier": F.col("precip_multiplier") - 1.0,
    }
    return days.groupBy("_day").agg(*[
        F.sum(F.col(part) * effect).alias(f"{part}_{name}")
        for name, effect in effects.items() for part in ("_level", "_slope")])


def event_window_factors(
    df: DataFrame, windows: DataFrame, at: str | Column = "observation_ts", ramp_days: int = RAMP_DAYS,
) -> DataFrame:
    """Add the summed anomalies of the event windows at each instant.

    The range join becomes an equi-join on the day with a table of one row per day, so no row of ``df``
    is repeated or shuffled.
    """
    share = day_fraction(at)
    joined = df.withColumn("_day", col(at).cast("date")).join(
        F.broadcast(window_days(windows, ramp_days)), "_day", "left")
    return joined.select(*df.columns, *[
        (F.lit(rest) + F.coalesce(F.col(f"_level_{name}") + F.col(f"_slope_{name}") * share, F.lit(0.0))).alias(name)
        for name, rest in [("temp_anomaly", 0.0), ("humidity_anomaly", 0.0), ("precip_multiplier", 1.0)]])
