"""Views that give the general test tables the shape of observations, stations and daily facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.functions.clock import floor_to_minutes
from obslake.functions.exact import SCALE, dround, ratio, round_mean, round_ticks, ticks
from obslake.operators.calendar import calendar_attributes, spine_of
from obslake.operators.dedup import keep_first
from obslake.operators.enrich import derive_measures
from obslake.schema import EventRule

# Stand-in event windows within the years of the orders, 16 days apart like the real ones.
PERIODS = [
    ("Episode A", dt.date(1997, 3, 1), dt.date(1997, 5, 15)),
    ("Episode B", dt.date(1997, 6, 1), dt.date(1998, 5, 31)),
]
SPAN = (dt.date(1997, 3, 1), dt.date(1998, 5, 31))
# Stand-in windows within the month of the events; their ramps overlap.
OBS_WINDOWS = [
    ("Window A", dt.date(2024, 1, 3), dt.date(2024, 1, 8), 2.8, 8.0, 5.5),
    ("Window B", dt.date(2024, 1, 18), dt.date(2024, 1, 24), 1.4, 4.0, 2.2),
]
DAILY_RULES = [
    EventRule("Calor extremo", "temp_max_c", ">", 45, "max above 45"),
    EventRule("Lluvia intensa", "precip_total_mm", ">", 20, "rain above 20"),
    EventRule("Déficit hídrico severo", "water_balance_mm", "<", -7, "balance below -7"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly readings of four stations from ``events``; slots repeat, so there is work to dedup."""
    events = table(spark, sf_dir, "events")
    n, v = F.col("event_id"), F.round(F.col("value") * 100).cast("bigint")
    hour = F.hour("ts")

    def reading(value: Column, missing: int, spike: int, outlier: float) -> Column:
        return F.when(n % missing == 0, None).when(n % spike == 1, outlier).otherwise(value).cast("double")

    compass = F.array(*[F.lit(d) for d in ("N", "NE", "E", "SE", "S", "SW", "W", "NW")])
    wind = (n * 7 % 300) / F.lit(10.0)
    return events.select(
        "event_id", F.concat(F.lit("STN_0"), (F.col("user_id") % 4 + 1).cast("string")).alias("station_id"),
        F.col("ts").alias("event_ts"), floor_to_minutes("ts", 30).alias("observation_ts"),
        reading(15 + (v % 200) / F.lit(10.0), 331, 499, 99.0).alias("temp_out_c"),
        reading(30 + v % 71, 337, 503, 101.0).alias("humidity_pct"),
        wind.alias("wind_speed_kmh"), (wind + v % 12).alias("wind_gust_kmh"),
        F.element_at(compass, (n % 8 + 1).cast("int")).alias("wind_dir"),
        (1000 + v % 20).cast("double").alias("pressure_hpa"),
        F.when(F.col("event_type") == "signup", (v % 50) / F.lit(10.0)).otherwise(F.lit(0.0)).alias("precip_mm"),
        F.when(hour.between(6, 18), v % 1100).otherwise(0).cast("double").alias("solar_wm2"),
    )


def enriched(obs: DataFrame) -> DataFrame:
    """Add the derived measures that the fact tables read."""
    return derive_measures(obs, ["dew_point_c", "uv_index", "etp_mm", "heat_index_c", "thsw_index_c"], dround)


def unique_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and slot: the smallest event id."""
    return keep_first(observations(spark, sf_dir), ["event_id"])


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations from suppliers, with their nation as zone.  Coordinates follow from the key."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    places = n.join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("s_suppkey")
    return s.join(places, s.s_nationkey == places.n_nationkey).select(
        F.concat(F.lit("STN_"), key.cast("string")).alias("station_id"), F.col("s_name").alias("station_name"),
        F.col("n_name").alias("zone"), F.col("r_name").alias("region"),
        (key % 180 - 90).cast("double").alias("latitude"), (key % 360 - 180).cast("double").alias("longitude"),
        (key % 4000).cast("int").alias("altitude_m"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily fact over seven years: line items per supplier and ship date."""
    quantity = F.col("l_quantity")
    rain, loss = ticks(F.col("l_discount") * 100), ticks(F.col("l_tax") * 100)
    items = table(spark, sf_dir, "lineitem")
    states = items.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date_local")).agg(
        F.sum(ticks(quantity)).alias("q"), F.count("*").alias("n"), F.max(quantity).alias("hi"), F.min(quantity).alias("lo"),
        F.sum(rain).alias("rain"), F.sum(loss).alias("loss"), F.sum("l_linenumber").alias("lines"),
        F.max("l_linenumber").alias("line_hi"), F.max(rain).alias("rain_hi"))
    return states.select(
        F.concat(F.lit("STN_"), F.col("l_suppkey").cast("string")).alias("station_id"), "date_local",
        round_mean(F.col("q"), F.col("n"), 2).alias("temp_avg_c"),
        F.col("hi").alias("temp_max_c"), F.col("lo").alias("temp_min_c"),
        round_ticks(F.col("rain"), 2).alias("precip_total_mm"), round_ticks(F.col("loss"), 2).alias("etp_total_mm"),
        round_ticks(F.col("rain") - F.col("loss"), 2).alias("water_balance_mm"),
        dround(ratio(F.col("lines") * 10, F.col("n")), 1).alias("humidity_avg_pct"),
        F.when(F.col("hi") > 45, 1).otherwise(0).alias("is_hot_day"),
        F.when(F.col("rain") > 2 * SCALE, 1).otherwise(0).alias("is_rainy_day"),
        F.when(F.col("line_hi") > 5, 1).otherwise(0).alias("is_windy_day"),
        F.when(F.col("rain_hi") > 9 * SCALE, 1).otherwise(0).alias("is_uv_extreme"),
        F.col("n").alias("n_observations"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of all the years that have line items, with the stand-in periods."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date_local"))
    return calendar_attributes(spine_of(days), periods=PERIODS, span=SPAN)
