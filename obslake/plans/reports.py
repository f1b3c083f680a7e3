"""The data behind the report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.functions.clock import days_between
from obslake.functions.exact import amount, dround, mean, ratio, ticks
from obslake.operators.metrics import evaluate
from obslake.schema import STEPS_PER_DAY

CORE = ["temp_avg", "temp_max", "temp_min", "humidity_avg", "precip_sum", "etp_sum", "balance_sum", "n_days"]
EXTREMES = ["hot_days", "rainy_days", "windy_days", "uv_days", "hot_days_share"]


def overview(daily: DataFrame, **selection) -> DataFrame:
    """The headline figures of a selection, one row."""
    return evaluate(daily, CORE, **selection)


def station_map(daily: DataFrame, stations: DataFrame, metrics: Sequence[str] = ("temp_avg", "precip_sum")) -> DataFrame:
    """Measures per station with its place."""
    places = stations.select("station_id", "station_name", "latitude", "longitude")
    return places.join(evaluate(daily, list(metrics), ["station_id"]), "station_id")


def series(
    daily: DataFrame, metrics: Sequence[str], grain: Sequence[str] = ("date_local",), calendar: DataFrame | None = None,
) -> DataFrame:
    """Measures per station over time; a grain other than the day needs the calendar that has it."""
    return evaluate(daily, list(metrics), ["station_id", *grain], calendar)


def rain_by_month(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rain of each month next to that of the year before."""
    return evaluate(daily, ["precip_sum", "precip_sum_ly", "precip_ratio_ly"], ["year", "month"], calendar)


def month_heatmap(daily: DataFrame, measure: str, how: str = "mean", digits: int = 4, by_year: bool = False) -> DataFrame:
    """A row per station (and year), a column per month of the year."""
    if how not in ("mean", "sum"):
        raise ValueError("how must be 'mean' or 'sum'")
    total = F.sum(ticks(measure))
    cell = mean(total, F.count(ticks(measure))) if how == "mean" else amount(total)
    keys = ["station_id"] + ([F.year("date_local").alias("year")] if by_year else [])
    cells = daily.groupBy(*keys, F.month("date_local").alias("_m")).agg(dround(cell, digits).alias("_v"))
    months = list(range(1, 13))
    wide = cells.groupBy(*cells.columns[:-2]).pivot("_m", months).agg(F.max("_v"))
    return wide.withColumnsRenamed({str(m): f"m{m:02d}" for m in months})


def top_events(events: DataFrame, k: int) -> DataFrame:
    """The ``k`` events of greatest magnitude."""
    order = [F.col("magnitude").desc_nulls_last(), "date_local", "station_id", "event_type"]
    return events.orderBy(*order).limit(k)


def events_by_type(events: DataFrame, by_month: bool = False) -> DataFrame:
    keys = ["event_type"] + ([F.month("date_local").alias("month")] if by_month else [])
    return events.groupBy(*keys).agg(F.count("*").alias("n_events"))


def negative_balance_months(monthly: DataFrame) -> DataFrame:
    """How many station-months lost more water than it rained."""
    counts = monthly.agg(F.count_if(F.col("water_balance_mm") < 0).alias("n_negative"), F.count("*").alias("n_months"))
    return counts.withColumn("negative_share", dround(ratio(F.col("n_negative"), F.col("n_months")), 6))


_BITS = 48  # slots of one word of a day's bitmap


def _slots_by_day(obs: DataFrame, minutes: int) -> DataFrame:
    """Every station on every day of the data's range (``lo`` and ``hi``, the first and last slot seen), with the slots that have
    a reading as bits: one row per ``_BITS`` slots of the day (``word``).

    The readings are read once: a bitmap folds before the shuffle, and days without any reading come from the step to
    the station's next day, so no station carries the whole range.
    """
    if minutes < 1 or 1440 % minutes:
        raise ValueError("slots must divide the day")
    words = -(-1440 // minutes // _BITS)
    ts = F.col("observation_ts").cast("timestamp_ntz")
    slot = F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("_slot"), F.lit(_BITS)))
    bits = [F.bit_or(F.when(F.floor(F.col("_slot") / _BITS) == w, bit)).alias(f"bits_{w}") for w in range(words)]
    read = obs.filter(ts.isNotNull()).select("station_id", ts.cast("date").alias("day"), slot.alias("_slot"))
    seen = read.groupBy("station_id", "day").agg(*bits)
    filled = [F.coalesce(f"bits_{w}", F.lit(0).cast("bigint")) for w in range(words)]
    # the lowest and highest slot of a day, by the bits of its first and last word that has any
    low = F.coalesce(*[F.when(b != 0, w * _BITS + F.bit_count(b.bitwiseAND(-b) - 1)) for w, b in enumerate(filled)])
    high = F.coalesce(*[F.when(b != 0, w * _BITS + 63 - _leading_zeros(b)) for w, b in reversed(list(enumerate(filled)))])
    bounds = seen.agg(F.struct(
        F.min(F.struct("day", low.alias("slot"))).alias("lo"), F.max(F.struct("day", high.alias("slot"))).alias("hi"))).scalar()
    by_day = Window.partitionBy("station_id").orderBy("day")
    steps = seen.select(
        "station_id", "day", F.array(*filled).alias("words"), bounds.alias("range"),
        F.row_number().over(by_day).alias("_nth"), F.lead("day").over(by_day).alias("_next"))
    first = F.when(F.col("_nth") == 1, F.col("range.lo.day")).otherwise(F.col("day"))
    last = F.coalesce(F.date_sub("_next", 1), F.col("range.hi.day"))
    days = steps.withColumn("date_local", F.explode(days_between(first, last)))
    own = F.col("date_local") == F.col("day")
    return days.select("station_id", "date_local", "range", F.posexplode("words").alias("word", "_bits"), own.alias("_own")).select(
        "station_id", "date_local", "range", "word", F.when(F.col("_own"), F.col("_bits")).otherwise(0).alias("bits"))


def _leading_zeros(b: Column) -> Column:
    """Of a positive whole number of 64 bits: spread the highest bit down and count what is left."""
    for shift in (1, 2, 4, 8, 16, 32):
        b = b.bitwiseOR(F.shiftright(b, shift))
    return 64 - F.bit_count(b)


def completeness(obs: DataFrame, expected_per_day: int = STEPS_PER_DAY) -> DataFrame:
    """Slots with a reading against expected ones for every station on every day of the data's range."""
    by_word = _slots_by_day(obs, 1440 // expected_per_day)
    observed = F.bit_count("bits").cast("bigint")
    if expected_per_day > _BITS:
        by_word = by_word.groupBy("station_id", "date_local").agg(F.sum(observed).alias("_n"))
        observed = F.col("_n")
    return by_word.select(
        "station_id", "date_local", observed.alias("n_observed"), F.lit(expected_per_day).alias("n_expected"),
        dround(observed.cast("double") / float(expected_per_day), 6).alias("completeness"))


def missing_slots(obs: DataFrame, minutes: int = 30) -> DataFrame:
    """Slots per station without any reading, between the first and the last slot of the data."""
    days = _slots_by_day(obs, minutes)
    places = F.sequence(F.lit(0), F.lit(min(_BITS, 1440 // minutes) - 1))
    empty = F.filter(places, lambda i: F.getbit("bits", i) == 0)
    slot = F.col("word") * _BITS + F.col("_place")
    own = F.struct(F.col("date_local").alias("day"), slot.cast("int").alias("slot"))
    inside = (own >= F.struct(F.col("range.lo.day").alias("day"), F.col("range.lo.slot").cast("int").alias("slot"))) & (
        own <= F.struct(F.col("range.hi.day").alias("day"), F.col("range.hi.slot").cast("int").alias("slot")))
    instant = F.timestamp_add("MINUTE", slot * minutes, F.col("date_local").cast("timestamp_ntz"))
    return days.withColumn("_place", F.explode(empty)).filter((slot < 1440 // minutes) & inside).select(
        "station_id", instant.cast("timestamp_ntz").alias("observation_ts"))


def periods_by_season(daily: DataFrame, calendar: DataFrame, metrics: Sequence[str] = ("temp_avg", "precip_sum", "n_days")):
    """Measures per ENSO label and season."""
    return evaluate(daily, list(metrics), ["enso_period", "season"], calendar)
