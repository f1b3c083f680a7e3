"""Dimensions, facts and the joined view of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.functions.clock import date_id
from obslake.functions.exact import NAN, amount, dround, round_mean, round_ticks, ticks
from obslake.schema import COMPASS, DAY_FLAGS, STATION_SCHEMA, STATIONS, STEPS_PER_DAY
from obslake.session import literal_rows

OBSERVATION_COLUMNS = [
    "temp_out_c", "humidity_pct", "dew_point_c", "wind_speed_kmh", "wind_gust_kmh", "wind_dir", "pressure_hpa",
    "precip_mm", "solar_wm2", "uv_index", "etp_mm", "heat_index_c", "thsw_index_c", "quality_flag",
]
VIEW_STATION_COLUMNS = ["station_name", "zone", "latitude", "longitude", "altitude_m"]
VIEW_DATE_COLUMNS = ["year", "quarter", "month", "month_name", "season", "enso_period", "is_el_nino"]


def dim_station(spark: SparkSession, rows=STATIONS) -> DataFrame:
    """The station dimension from configured rows; a repeated key is refused."""
    ids = [r[0] for r in rows]
    if len(set(ids)) != len(ids):
        raise ValueError("station_id must be unique")
    return literal_rows(spark, rows, STATION_SCHEMA)


def fact_observations(silver: DataFrame) -> DataFrame:
    """Half-hourly fact: 17 columns of the typed layer and two date keys."""
    day = F.col("observation_ts").cast("date")
    return silver.select(
        "station_id", "observation_ts", date_id("observation_ts").alias("date_id"), day.alias("date_local"), "hour",
        *OBSERVATION_COLUMNS,
    )


_SUMMED = ["temp_out_c", "humidity_pct", "wind_speed_kmh", "precip_mm", "solar_wm2", "etp_mm", "pressure_hpa"]
_HIGHEST = ["temp_out_c", "humidity_pct", "wind_gust_kmh", "solar_wm2", "uv_index", "heat_index_c", "thsw_index_c"]
_LOWEST = ["temp_out_c", "humidity_pct"]
_DAY = ["station_id", "date_local"]


def _day_states() -> list[Column]:
    states = [F.count("*").alias("n"), F.count("quality_flag").alias("n_flagged"),
              F.count_if(F.col("precip_mm") > 0).alias("n_rain")]
    for c in _SUMMED:
        states += [F.sum(ticks(c)).alias(f"sum_{c}"), F.count(c).alias(f"cnt_{c}")]
    # NaN is the greatest of all readings, so a maximum shows it as well.
    states += [F.bool_or(F.isnan(c)).alias(f"nan_{c}") for c in _SUMMED if c not in _HIGHEST]
    states += [F.max(c).alias(f"max_{c}") for c in _HIGHEST]
    return states + [F.min(c).alias(f"min_{c}") for c in _LOWEST]


def _merged(state: str) -> Column:
    """How the parts of a state add up, which its name tells."""
    fold = {"max": F.max, "min": F.min, "nan": F.bool_or}.get(state.split("_")[0], F.sum)
    return fold(state).alias(state)


def _prevailing(points: Sequence[str]) -> Column:
    """Most frequent direction, the first in alphabetical order on a tie: the best of the listed ones, which have a count each,
    against the best of all others."""
    names = sorted(points)
    others = F.col("_other")
    if not names:
        return others["label"]
    counts = F.array(*[F.col(f"dir_{p}") for p in names])
    most = F.array_max(counts)
    winner = F.element_at(F.array(*[F.lit(p) for p in names]), F.array_position(counts, most).cast("int"))
    listed = F.when(most > 0, F.struct((-most).alias("k"), winner.alias("label")))
    return F.least(listed, others)["label"]


def fact_daily_summary(
    obs: DataFrame, expected_per_day: int = STEPS_PER_DAY, flags: Mapping[str, float] = DAY_FLAGS,
    directions: Sequence[str] | None = COMPASS,
) -> DataFrame:
    """One row per station and day with 29 columns.

    All readings fold in one hash aggregate with map-side combine.  The prevailing direction is a count per listed compass
    point in the same aggregate; any other label is a group of its own beside them, so that a station-day leaves each task as one
    row of numbers, and one more for each label that is not listed (all of them with ``directions=None``).
    A second aggregate over these few rows folds the groups of a day.
    """
    points = list(directions or ())
    label = F.when(~F.col("wind_dir").isin(points), F.col("wind_dir")) if points else F.col("wind_dir")
    states = [*_day_states(), *[F.count_if(F.col("wind_dir") == p).alias(f"dir_{p}") for p in points]]
    parts = obs.groupBy(*_DAY, label.alias("_label")).agg(*states)
    other = F.min(F.when(F.col("_label").isNotNull(), F.struct((-F.col("n")).alias("k"), F.col("_label").alias("label"))))
    day = parts.groupBy(*_DAY).agg(*[_merged(c) for c in parts.columns if c not in (*_DAY, "_label")], other.alias("_other"))
    prevailing = _prevailing(points)

    s, n, hi, lo = (lambda c, p=p: F.col(f"{p}_{c}") for p in ("sum", "cnt", "max", "min"))

    def or_nan(c: str, value: Column) -> Column:
        seen = F.isnan(hi(c)) if c in _HIGHEST else F.col(f"nan_{c}")
        return F.when(seen, F.lit(NAN)).otherwise(value)

    def average(c: str, digits: int) -> Column:
        return or_nan(c, round_mean(s(c), n(c), digits))

    def total(c: str, digits: int) -> Column:
        return or_nan(c, round_ticks(s(c), digits))

    def shown(reading: Column, digits: int) -> Column:
        # A reading carries no arithmetic noise, so the built-in rounding of its decimal value will do.
        return F.round(reading, digits)

    def above(value: Column, flag: str) -> Column:
        return F.when(value > flags[flag], 1).otherwise(0).alias(flag)

    balance = round_ticks(s("precip_mm") - s("etp_mm"), 2)
    return day.select(
        *_DAY, date_id("date_local").alias("date_id"),
        average("temp_out_c", 2).alias("temp_avg_c"),
        shown(hi("temp_out_c"), 2).alias("temp_max_c"), shown(lo("temp_out_c"), 2).alias("temp_min_c"),
        shown(hi("temp_out_c") - lo("temp_out_c"), 2).alias("temp_amplitude_c"),
        average("humidity_pct", 1).alias("humidity_avg_pct"),
        shown(lo("humidity_pct"), 0).alias("humidity_min_pct"), shown(hi("humidity_pct"), 0).alias("humidity_max_pct"),
        average("wind_speed_kmh", 1).alias("wind_avg_kmh"), shown(hi("wind_gust_kmh"), 1).alias("wind_gust_max_kmh"),
        prevailing.alias("wind_dominant_dir"),
        total("precip_mm", 2).alias("precip_total_mm"), F.col("n_rain").alias("rainy_intervals"),
        shown(hi("solar_wm2"), 0).alias("solar_max_wm2"),
        or_nan("solar_wm2", dround(amount(s("solar_wm2")) / float(expected_per_day), 0)).alias("solar_daily_avg_wm2"),
        shown(hi("uv_index"), 1).alias("uv_max"),
        total("etp_mm", 2).alias("etp_total_mm"),
        or_nan("precip_mm", or_nan("etp_mm", balance)).alias("water_balance_mm"),
        shown(hi("heat_index_c"), 1).alias("heat_index_max_c"), shown(hi("thsw_index_c"), 1).alias("thsw_max_c"),
        average("pressure_hpa", 1).alias("pressure_avg_hpa"),
        F.col("n").alias("n_observations"), "n_flagged",
        above(hi("temp_out_c"), "is_hot_day"), above(or_nan("precip_mm", amount(s("precip_mm"))), "is_rainy_day"),
        above(hi("wind_gust_kmh"), "is_windy_day"), above(hi("uv_index"), "is_uv_extreme"),
    )


def fact_monthly_summary(daily: DataFrame) -> DataFrame:
    """One row per station and month over the (already rounded) daily rows, 16 columns.

    Measures and flags the daily rows do not have are left out.
    """
    have = set(daily.columns)
    d = F.col("date_local")

    def nan_or(c: str, value: Column) -> Column:
        return F.when(F.bool_or(F.isnan(c)), F.lit(NAN)).otherwise(value)

    columns: list[Column] = []
    for c, digits in [("temp_avg_c", 2), ("humidity_avg_pct", 1)]:
        if c in have:
            columns.append(nan_or(c, round_mean(F.sum(ticks(c)), F.count(c), digits)).alias(c))
    columns += [dround(F.max("temp_max_c"), 2).alias("temp_max_c"), dround(F.min("temp_min_c"), 2).alias("temp_min_c")]
    for c in ("precip_total_mm", "etp_total_mm", "water_balance_mm"):
        columns.append(nan_or(c, round_ticks(F.sum(ticks(c)), 1)).alias(c))
    for flag, out in [("is_hot_day", "n_hot_days"), ("is_rainy_day", "n_rainy_days"),
                      ("is_windy_day", "n_windy_days"), ("is_uv_extreme", "n_uv_extreme_days")]:
        if flag in have:
            columns.append(F.sum(flag).alias(out))
    return daily.groupBy(
        "station_id", F.year(d).alias("year"), F.month(d).alias("month"), F.trunc(d, "MM").alias("month_start"),
    ).agg(*columns, F.count("*").alias("n_days"))


def unmatched_days(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days of the facts that the calendar does not have; measures along the calendar leave them out."""
    return facts.select("date_local").distinct().join(calendar.select("date_local"), "date_local", "left_anti")


def join_dimensions(
    daily: DataFrame, stations: DataFrame, calendar: DataFrame,
    station_columns=VIEW_STATION_COLUMNS, date_columns=VIEW_DATE_COLUMNS,
) -> DataFrame:
    """The daily rows with the attributes of their station and day (NULL where there is none).

    The calendar is bounded by its number of days and is broadcast.  The station dimension may be as
    large as the network, so its join strategy is left to adaptive execution, which also splits a
    station that holds most of the rows.
    """
    s = stations.select("station_id", *station_columns)
    d = calendar.select("date_local", *date_columns)
    return daily.join(F.broadcast(d), "date_local", "left").join(s, "station_id", "left").select(
        *daily.columns, *station_columns, *date_columns)
