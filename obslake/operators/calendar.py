"""Date and time spines and the calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.functions.clock import date_id, days_between
from obslake.functions.exact import col
from obslake.schema import CALENDAR_RANGE, ENSO_NONE, ENSO_PERIODS, ENSO_SPAN, SEASONS

#: A calendar is broadcast; this is the most days it may hold (400 years).
MAX_DAYS = 146_097


def date_spine(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    if (hi - lo).days >= MAX_DAYS:
        raise ValueError(f"a calendar may span at most {MAX_DAYS} days")
    return spark.range(1).select(F.explode(days_between(F.lit(lo), F.lit(hi))).alias("date_local"))


def spine_of(facts: DataFrame, date: str = "date_local") -> DataFrame:
    """One row per day of all the years the facts touch, so that no fact is left without a day."""
    bounds = facts.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    lo, hi = F.trunc("lo", "YEAR"), F.last_day(F.add_months(F.trunc("hi", "YEAR"), 11))
    in_bounds = F.assert_true(F.datediff(hi, lo) < MAX_DAYS, F.lit(f"a calendar may span at most {MAX_DAYS} days"))
    return (
        bounds.filter(F.col("lo").isNotNull() & in_bounds.isNull())
        .select(F.explode(days_between(lo, hi)).alias("date_local"))
    )


def time_spine(
    entities: DataFrame, lo: dt.datetime | Column, hi: dt.datetime | Column, minutes: int = 30,
) -> DataFrame:
    """One row per entity and step, the end included."""
    steps = F.sequence(
        F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"), F.make_dt_interval(mins=F.lit(minutes)))
    return entities.select("*", F.explode(steps).alias("observation_ts"))


def season(month: Column, seasons: dict[str, list[int]] | None = None) -> Column:
    label = F.lit(None).cast("string")
    for name, months in (seasons or SEASONS).items():
        label = F.when(month.isin(months), F.lit(name)).otherwise(label)
    return label


def period_label(day: Column, periods=ENSO_PERIODS, none: str = ENSO_NONE) -> Column:
    """Name of the first period holding the day, both ends included."""
    label = F.lit(none)
    for name, start, end in reversed(periods):
        label = F.when(day.between(F.lit(start), F.lit(end)), F.lit(name)).otherwise(label)
    return label


def calendar_attributes(spine: DataFrame, periods=ENSO_PERIODS, span=ENSO_SPAN, date: str = "date_local") -> DataFrame:
    """The calendar dimension, 13 columns, over any spine of days."""
    day = col(date)
    weekday = (F.dayofweek(day) - 1).cast("int")
    return spine.select(
        day.alias("date_local"), date_id(day).alias("date_id"),
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.when(weekday.isin(0, 6), 1).otherwise(0).alias("is_weekend"),
        season(F.month(day)).alias("season"), period_label(day, periods).alias("enso_period"),
        F.when(day.between(F.lit(span[0]), F.lit(span[1])), 1).otherwise(0).alias("is_el_nino"),
    )


def dim_date(spark: SparkSession, lo: dt.date = CALENDAR_RANGE[0], hi: dt.date = CALENDAR_RANGE[1], **kw) -> DataFrame:
    return calendar_attributes(date_spine(spark, lo, hi), **kw)
