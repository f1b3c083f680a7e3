"""Every registered query: a name, and how to run it over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.functions import meteo
from obslake.functions.exact import amount, dround, ticks
from obslake.operators import forecast as fc, star
from obslake.operators.calendar import season
from obslake.operators.dedup import duplicate_keys
from obslake.operators.events import detect_events, event_window_factors, event_windows, extreme_events
from obslake.operators.gapfill import forward_fill
from obslake.operators.metrics import evaluate, evaluate_forecast, hottest_station, rank_stations
from obslake.operators.silver import flag_rows, profile, profile_totals, quality_flag, type_rows
from obslake.plans import adapters as ad, reports
from obslake.session import cut_lineage, new_shared_path
from obslake.sources import station_text as text, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at six decimals, so that results compare across engines."""
    return df.select(*[
        dround(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
        for f in df.schema.fields])


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return flag_rows(ad.enriched(ad.unique_observations(spark, d)))


def _export_rows(spark: SparkSession, d: str) -> DataFrame:
    """Observations as the text cells of an export, at the minute they were made."""
    return text.export_cells(ad.observations(spark, d).withColumn("observation_ts", F.col("event_ts")))


_MEASURED = ["temp_out_c", "humidity_pct", "wind_speed_kmh", "wind_gust_kmh", "wind_dir", "pressure_hpa", "precip_mm", "solar_wm2"]


# --- ingestion and typing -------------------------------------------------------------------------

@query
def station_exports(spark, d):
    """Write the observations as station exports, read the text back, type it, count per station and day."""
    path = new_shared_path(spark, "exports")
    names = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i")).select(
        F.concat(F.lit("STN_0"), F.col("i").cast("string")).alias("station_id"),
        F.concat(F.lit("Station "), F.col("i").cast("string")).alias("station_name"))
    text.write_exports(_export_rows(spark, d), names, path)
    good, _ = text.split_quarantine(text.read_exports(spark, path))
    typed = type_rows(good)
    return typed.groupBy("station_id", F.col("observation_ts").cast("date").alias("date_local")).agg(
        F.count("*").alias("n_rows"), F.count("temp_out_c").alias("n_temp"),
        amount(F.sum(ticks("temp_out_c"))).alias("temp_sum"),
        F.max("humidity_pct").alias("humidity_max"), F.min("wind_dir").alias("wind_dir_min"))


@query
def quarantine_counts(spark, d):
    """Exports with bad lines among the rows: every line is a row, a header, a name, or set aside for a reason."""
    path = new_shared_path(spark, "exports")
    names = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i")).select(
        F.concat(F.lit("STN_0"), F.col("i").cast("string")).alias("station_id"), F.lit("Any name").alias("station_name"))
    text.write_exports(_export_rows(spark, d), names, path)
    n = F.col("event_id")
    bad = ad.observations(spark, d).select("station_id", F.explode(F.filter(F.array(
        F.when(n % 97 == 0, F.concat(F.lit("logger restarted "), n.cast("string"))),
        F.when(n % 101 == 0, F.concat(F.lit("01/02/24\t00:30"), F.repeat(F.lit("\t1"), 37))),
        F.when(n % 103 == 0, F.concat(F.lit("32/01/24\t00:30"), F.repeat(F.lit("\t1"), 36))),
        F.when(n % 107 == 0, F.lit("01/02/24\t00:30\t1")),
        F.when(n % 109 == 0, F.lit("battery low\tvolts\t3"))), lambda x: x.isNotNull())).alias("value"))
    bad.write.mode("append").partitionBy("station_id").text(path)
    lines = cut_lineage(text.with_partition_keys(text.read_lines(spark, path)).select(
        "station_id", "source_path", "ingestion_ts", "Date", "line", "place", "year"))
    return text.count_lines(lines)


@query
def silver_typed(spark, d):
    return type_rows(_export_rows(spark, d)).select("station_id", "observation_ts", "date_local_str", "time_local_str", *_MEASURED)


@query
def silver_dedup(spark, d):
    return ad.unique_observations(spark, d)


@query
def quality_flags(spark, d):
    flagged = flag_rows(ad.unique_observations(spark, d))
    return flagged.groupBy("station_id", "quality_flag").agg(F.count("*").alias("n_rows"))


@query
def quality_flag_rows(spark, d):
    """Every raw observation with its flag and the parts of its instant."""
    return flag_rows(ad.observations(spark, d)).select("event_id", "quality_flag", "year", "month", "day", "hour")


@query
def silver_profile(spark, d):
    return profile(flag_rows(ad.unique_observations(spark, d)))


@query
def silver_totals(spark, d):
    return profile_totals(flag_rows(ad.unique_observations(spark, d)))


@query
def bronze_partitions(spark, d):
    obs = ad.daily(spark, d).select("station_id", F.year("date_local").alias("year"), F.month("date_local").alias("month"))
    return tables.partition_counts(obs)


@query
def forward_fill_short_gaps(spark, d):
    obs = ad.unique_observations(spark, d).select("station_id", "observation_ts", "temp_out_c", "humidity_pct")
    return forward_fill(obs, ["temp_out_c", "humidity_pct"])


# --- dimensions and facts -------------------------------------------------------------------------

@query
def dim_date(spark, d):
    return ad.calendar(spark, d)


@query
def dim_station(spark, d):
    return ad.stations(spark, d)


@query
def station_key_check(spark, d):
    """Rows, and keys that are not unique, of the station dimension."""
    st = ad.stations(spark, d)
    repeated = duplicate_keys(st, ["station_id"]).agg(F.count("*")).scalar()
    return st.agg(F.count("*").alias("n_rows")).withColumn("n_repeated_keys", repeated)


@query
def stations_without_data(spark, d):
    """Stations that are missing from the delivery of the last day."""
    day = F.col("l_shipdate").cast("date")
    items = ad.table(spark, d, "lineitem").select("l_suppkey", day.alias("date_local"))
    last = items.filter(F.col("date_local") == items.agg(F.max("date_local")).scalar())
    delivered = last.select(F.concat(F.lit("STN_"), F.col("l_suppkey").cast("string")).alias("station_id"))
    return text.missing_stations(delivered, ad.stations(spark, d))


@query
def fact_observations(spark, d):
    return star.fact_observations(_flagged(spark, d))


@query
def fact_daily_summary(spark, d):
    return star.fact_daily_summary(star.fact_observations(_flagged(spark, d)))


@query
def daily_directions_any(spark, d):
    """The prevailing direction where three in eight readings have a Spanish label, which the list of compass points lacks."""
    spanish = F.when(F.col("wind_dir") == "W", "O").when(F.col("wind_dir") == "SW", "SO").when(F.col("wind_dir") == "NW", "NO")
    obs = star.fact_observations(_flagged(spark, d)).withColumn("wind_dir", F.coalesce(spanish, "wind_dir"))
    return star.fact_daily_summary(obs).select("station_id", "date_local", "wind_dominant_dir")


@query
def fact_monthly_summary(spark, d):
    return star.fact_monthly_summary(ad.daily(spark, d))


@query
def daily_view(spark, d):
    return star.join_dimensions(ad.daily(spark, d), ad.stations(spark, d), ad.calendar(spark, d))


@query
def gold_row_counts(spark, d):
    daily = ad.daily(spark, d)
    return tables.row_counts({
        "dim_station": ad.stations(spark, d), "dim_date": ad.calendar(spark, d),
        "fact_observations_30min": ad.unique_observations(spark, d), "fact_daily_summary": daily,
        "fact_monthly_summary": daily.select("station_id", F.trunc("date_local", "MM")).distinct(),
        "fact_extreme_events": detect_events(daily, ad.DAILY_RULES),
    })


# --- events ---------------------------------------------------------------------------------------

@query
def extreme_event_hits(spark, d):
    return detect_events(ad.daily(spark, d), ad.DAILY_RULES)


@query
def extreme_event_ids(spark, d):
    return extreme_events(ad.daily(spark, d), ad.DAILY_RULES)


@query
def extreme_events_of_observations(spark, d):
    """The five weather rules on the daily summary of the observations."""
    return detect_events(star.fact_daily_summary(star.fact_observations(_flagged(spark, d))))


@query
def top_events(spark, d):
    return reports.top_events(detect_events(ad.daily(spark, d), ad.DAILY_RULES), 25)


@query
def events_by_type(spark, d):
    return reports.events_by_type(detect_events(ad.daily(spark, d), ad.DAILY_RULES))


@query
def events_by_type_and_month(spark, d):
    return reports.events_by_type(detect_events(ad.daily(spark, d), ad.DAILY_RULES), by_month=True)


@query
def event_window_weights(spark, d):
    events = ad.table(spark, d, "events").select("event_id", F.col("ts").alias("observation_ts"))
    return _rounded(event_window_factors(events, event_windows(spark, ad.OBS_WINDOWS), ramp_days=7))


# --- derived measures, one query per formula over every observation -------------------------------

def _derived(name: str, columns: Callable[[], dict[str, Column]]) -> None:
    def run(spark, d):
        obs = ad.observations(spark, d)
        return _rounded(obs.select("event_id", *[c.alias(k) for k, c in columns().items()]))

    QUERIES[name] = run


_T, _RH, _V, _S, _P = "temp_out_c", "humidity_pct", "wind_speed_kmh", "solar_wm2", "pressure_hpa"
_derived("derived_dew_point", lambda: {"dew_point_c": meteo.dew_point_c(_T, _RH)})
_derived("derived_heat_index", lambda: {"heat_index_c": meteo.heat_index_c(_T, _RH)})
# Warmer and drier variants reach the other branches of the heat index.
_derived("derived_heat_index_extremes", lambda: {
    "heat_index_hot_c": meteo.heat_index_c(F.col(_T) + 15, _RH),
    "heat_index_dry_c": meteo.heat_index_c(F.col(_T) + 15, F.col(_RH) / 5)})
_derived("derived_wind_chill", lambda: {"wind_chill_c": meteo.wind_chill_c(F.col(_T) - 15, _V)})
_derived("derived_thw", lambda: {"thw_index_c": meteo.thw_index_c(_T, _RH, _V)})
_derived("derived_thsw", lambda: {"thsw_index_c": meteo.thsw_index_c(_T, _RH, _V, _S)})
_derived("derived_air_density", lambda: {"in_air_density": meteo.air_density_kg_m3(_T, _P, _RH)})
_derived("derived_degree_days", lambda: {
    "heat_dd": meteo.degree_days(_T, 18.0, "heat"), "cool_dd": meteo.degree_days(_T, 18.0, "cool")})
_derived("derived_etp", lambda: {"etp_mm": meteo.reference_etp_mm(_T, _RH, _V, _S, _P)})
_derived("derived_interval_measures", lambda: {
    "wind_run_km": meteo.wind_run_km(_V), "solar_energy_ly": meteo.solar_energy_ly(_S), "uv_index": meteo.uv_index(_S),
    "uv_dose_med": meteo.uv_dose_med(meteo.uv_index(_S)), "precip_rate_mmh": meteo.rain_rate_mmh("precip_mm")})
_derived("derived_indoor", lambda: {
    "in_dew_c": meteo.dew_point_c(F.col(_T) * 0.5 + 12, F.col(_RH) * 0.5 + 20),
    "in_heat_c": meteo.heat_index_c(F.col(_T) * 0.5 + 12, F.col(_RH) * 0.5 + 20)})


# --- metric layer ---------------------------------------------------------------------------------

@query
def kpis_core(spark, d):
    return _rounded(reports.overview(ad.daily(spark, d)))


@query
def kpis_extremes(spark, d):
    return _rounded(evaluate(ad.daily(spark, d), reports.EXTREMES, ["station_id"]))


@query
def yoy_by_month(spark, d):
    metrics = ["temp_avg", "temp_avg_ly", "temp_delta_ly", "temp_delta_ly_share", "precip_sum", "precip_sum_ly", "precip_ratio_ly"]
    return _rounded(evaluate(ad.daily(spark, d), metrics, ["year", "month"], ad.calendar(spark, d)))


@query
def yoy_by_station_year(spark, d):
    metrics = ["temp_avg", "temp_avg_ly", "temp_delta_ly", "precip_ratio_ly"]
    return _rounded(evaluate(ad.daily(spark, d), metrics, ["station_id", "year"], ad.calendar(spark, d)))


@query
def rain_by_month(spark, d):
    return _rounded(reports.rain_by_month(ad.daily(spark, d), ad.calendar(spark, d)))


@query
def ytd_by_station_month(spark, d):
    return _rounded(evaluate(
        ad.daily(spark, d), ["temp_ytd", "precip_ytd", "etp_ytd"], ["station_id", "year", "month"], ad.calendar(spark, d)))


@query
def ytd_by_period_label(spark, d):
    """Year to date at the last day of contexts that are spread over several years."""
    return _rounded(evaluate(ad.daily(spark, d), ["precip_sum", "precip_ytd"], ["station_id", "season"], ad.calendar(spark, d)))


@query
def ytd_by_year_day_of_month(spark, d):
    """Contexts that lie all over the year: the 5th of every month reaches to 5 December."""
    return _rounded(evaluate(ad.daily(spark, d), ["precip_sum", "temp_ytd", "precip_ytd"], ["year", "day_of_month"], ad.calendar(spark, d)))


@query
def ytd_after_last_reading(spark, d):
    """Every second station falls silent after April; its year to date stands until December."""
    silent = F.substring("station_id", -1, 1).isin("1", "3", "5", "7", "9") & (F.month("date_local") > 4)
    return _rounded(evaluate(
        ad.daily(spark, d), ["precip_sum", "precip_ytd", "etp_ytd"], ["station_id", "year", "month"], ad.calendar(spark, d), entities=~silent))


@query
def enso_split(spark, d):
    return _rounded(evaluate(ad.daily(spark, d), ["precip_sum", "precip_nino", "precip_normal"], ["year"], ad.calendar(spark, d)))


@query
def enso_split_override(spark, d):
    """The condition on the flag is replaced even where the flag itself is a context."""
    return _rounded(evaluate(
        ad.daily(spark, d), ["precip_sum", "precip_nino", "precip_normal"], ["year", "is_el_nino"], ad.calendar(spark, d)))


@query
def enso_split_of_selection(spark, d):
    """Only El Niño days are selected; the measures replace that condition and keep the one on the quarter."""
    return _rounded(evaluate(
        ad.daily(spark, d), ["precip_sum", "precip_nino", "precip_normal"], ["station_id", "year"], ad.calendar(spark, d),
        dates={"is_el_nino": [1], "quarter": [1, 2, 3]}))


@query
def deficit_of_selection(spark, d):
    """Only days that gained water are selected; severe deficit puts its own condition on the balance."""
    return _rounded(evaluate(
        ad.daily(spark, d), ["n_days", "precip_sum", "deficit_days", "deficit_days_share"], ["station_id", "year"], ad.calendar(spark, d),
        entities={"water_balance_mm": F.col("water_balance_mm") > 0}))


@query
def enso_anomaly(spark, d):
    return _rounded(evaluate(ad.daily(spark, d), ["temp_avg", "temp_anomaly"], ["station_id", "year"], ad.calendar(spark, d)))


@query
def enso_anomaly_of_selection(spark, d):
    """Only the days of one episode are selected, the history stays whole."""
    return _rounded(evaluate(
        ad.daily(spark, d), ["temp_avg", "temp_anomaly"], ["station_id"], ad.calendar(spark, d),
        dates=F.col("enso_period") == "Episode A"))


@query
def periods_by_season(spark, d):
    return _rounded(reports.periods_by_season(ad.daily(spark, d), ad.calendar(spark, d)))


@query
def water_management(spark, d):
    metrics = ["etp_per_day", "precip_per_day", "deficit_days", "deficit_days_share", "irrigation_advice"]
    return _rounded(evaluate(ad.daily(spark, d), metrics, ["station_id", "year", "month"], ad.calendar(spark, d)))


@query
def negative_balance_months(spark, d):
    return reports.negative_balance_months(star.fact_monthly_summary(ad.daily(spark, d)))


@query
def station_rankings(spark, d):
    ranks = {"temp_avg": "rank_temp", "etp_sum": "rank_etp"}
    return _rounded(rank_stations(ad.daily(spark, d), ad.stations(spark, d), ranks))


@query
def station_rankings_by_year(spark, d):
    return _rounded(rank_stations(
        ad.daily(spark, d), ad.stations(spark, d), {"etp_sum": "rank_etp"}, ["year"], ad.calendar(spark, d)))


@query
def hottest_stations(spark, d):
    return hottest_station(ad.daily(spark, d), ad.stations(spark, d), ["year", "month"], ad.calendar(spark, d))


@query
def heatmap_temperature(spark, d):
    return reports.month_heatmap(ad.daily(spark, d), "temp_avg_c")


@query
def heatmap_balance(spark, d):
    return reports.month_heatmap(ad.daily(spark, d), "water_balance_mm", how="sum")


@query
def heatmap_rain_by_year(spark, d):
    return reports.month_heatmap(ad.daily(spark, d), "precip_total_mm", how="sum", by_year=True)


@query
def station_map(spark, d):
    return _rounded(reports.station_map(ad.daily(spark, d), ad.stations(spark, d)))


@query
def daily_series(spark, d):
    return _rounded(reports.series(ad.daily(spark, d), ["temp_avg", "precip_sum"]))


@query
def monthly_series(spark, d):
    return _rounded(reports.series(ad.daily(spark, d), ["temp_avg", "precip_sum", "etp_sum"], ("year", "month"), ad.calendar(spark, d)))


@query
def stations_of_facts(spark, d):
    return ad.daily(spark, d).select("station_id").distinct().orderBy("station_id")


@query
def completeness(spark, d):
    return reports.completeness(ad.observations(spark, d))


@query
def completeness_by_ten_minutes(spark, d):
    """144 slots a day, three words of a bitmap."""
    obs = ad.observations(spark, d).withColumn("observation_ts", F.col("event_ts"))
    return reports.completeness(obs, 144)


@query
def missing_ten_minutes(spark, d):
    """Slots of ten minutes without any reading."""
    obs = ad.observations(spark, d).withColumn("observation_ts", F.col("event_ts"))
    return reports.missing_slots(obs, 10)


@query
def missing_slots(spark, d):
    return reports.missing_slots(ad.observations(spark, d))


# --- forecasting ----------------------------------------------------------------------------------

@query
def forecast_trend(spark, d):
    return fc.linear_trend(fc.history(ad.daily(spark, d)))


def _trend(spark: SparkSession, d: str) -> DataFrame:
    return fc.trend_forecast(fc.history(ad.daily(spark, d)))


@query
def forecast_trend_band(spark, d):
    return _trend(spark, d)


@query
def forecast_trend_summary(spark, d):
    return fc.summary(_trend(spark, d))


@query
def forecast_trend_kpis(spark, d):
    metrics = ["forecast_temp", "forecast_etp", "forecast_temp_lower", "forecast_temp_upper"]
    return _rounded(evaluate_forecast(_trend(spark, d), metrics, ["station_id"]))


@query
def history_and_trend(spark, d):
    series = fc.history(ad.daily(spark, d))
    return fc.recent_and_forecast(series, fc.trend_forecast(series))


@query
def forecast_seasonal_naive(spark, d):
    return fc.seasonal_naive(fc.history(ad.daily(spark, d)))


@query
def forecast_additive(spark, d):
    return fc.fact_forecast(ad.daily(spark, d)).drop("model_run_ts")


@query
def forecast_summary(spark, d):
    return fc.summary(fc.fact_forecast(ad.daily(spark, d)))


@query
def forecast_kpis(spark, d):
    metrics = ["forecast_temp", "forecast_etp", "forecast_temp_lower", "forecast_temp_upper"]
    return _rounded(evaluate_forecast(fc.fact_forecast(ad.daily(spark, d)), metrics, ["station_id"]), 3)


@query
def history_and_forecast(spark, d):
    daily = ad.daily(spark, d)
    return fc.recent_and_forecast(fc.history(daily), fc.fact_forecast(daily))
