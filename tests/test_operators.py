import datetime as dt
import random
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from obslake import schema
from obslake.operators import calendar as cal, star
from obslake.operators.dedup import duplicate_keys, keep_first, latest_delivery
from obslake.operators.events import detect_events, event_window_factors, event_windows, extreme_events, window_days
from obslake.operators.gapfill import forward_fill
from obslake.operators.numbering import dense_rank_desc, global_row_number, top_with_ties
from obslake.operators.silver import flag_rows, profile, profile_totals, quality_flag
from obslake.plans import reports
from obslake.session import cut_lineage

HOT = "s0"  # holds a third of all rows in the generated frames


def hot_station(i):
    return HOT if i % 3 == 0 else f"s{i % 50}"


# --- dedup ----------------------------------------------------------------------------------------

def test_dedup_keeps_latest_and_is_idempotent(spark, plan):
    t = dt.datetime
    rows = [("a", t(2023, 1, 1), 1.0, t(2024, 1, 1), "f1"), ("a", t(2023, 1, 1), 2.0, t(2024, 1, 2), "f1"),
            ("a", t(2023, 1, 1), 3.0, t(2024, 1, 2), "f0"), ("b", t(2023, 1, 1), 4.0, t(2024, 1, 1), "f1")]
    df = spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz, x double, ingestion_ts timestamp, source_file string")
    once = keep_first(df, latest_delivery(df, ["x"]))
    assert sorted(r.x for r in once.collect()) == [2.0, 4.0]
    twice = keep_first(once, latest_delivery(once, ["x"]))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    text = plan(once)
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text and text.index("Exchange hashpartitioning") < partial, "copies are dropped before the shuffle"


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [(r.k, r.n_rows) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        star.dim_station(spark, [schema.STATIONS[0], schema.STATIONS[0]])


# --- quality --------------------------------------------------------------------------------------

@pytest.mark.parametrize("values,want", [
    ((-10.0, 0.0, 950.0, 0.0, 0.0), None), ((55.0, 100.0, 1050.0, 200.0, 1500.0), None),
    ((-10.1, 50.0, 1000.0, 1.0, 1.0), "temp_out_of_range"), ((55.1, 101.0, 1000.0, 1.0, 1.0), "temp_out_of_range"),
    ((20.0, 100.1, 1000.0, 1.0, 1.0), "humidity_out_of_range"), ((20.0, 50.0, 949.9, 1.0, 1.0), "pressure_out_of_range"),
    ((20.0, 50.0, 1000.0, -0.1, 1.0), "wind_out_of_range"), ((20.0, 50.0, 1000.0, 1.0, 1500.1), "solar_out_of_range"),
    ((None, None, None, None, None), None), ((float("nan"), 50.0, 1000.0, 1.0, 1.0), "temp_out_of_range"),
])
def test_quality_flag(spark, values, want):
    names = [b[0] for b in schema.QUALITY_BOUNDS]
    df = spark.createDataFrame([values], ", ".join(f"{n} double" for n in names))
    assert df.select(quality_flag().alias("q")).first().q == want


def test_profile(spark):
    rows = [("a", dt.datetime(2023, 1, 1), 20.0), ("a", dt.datetime(2023, 1, 2), 99.0), ("b", dt.datetime(2023, 1, 1), None)]
    df = flag_rows(spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz, temp_out_c double"))
    assert [(r.station_id, r.n_rows, r.flagged) for r in profile(df).collect()] == [("a", 2, 1), ("b", 1, 0)]
    assert tuple(profile_totals(df).first()) == (3, 1, 33.33)
    assert profile_totals(df.limit(0)).first().flagged_pct is None


# --- calendar -------------------------------------------------------------------------------------

def test_calendar(spark):
    df = cal.dim_date(spark)
    rows = {r.date_local: r for r in df.collect()}
    assert len(rows) == 731 and len(df.columns) == 13
    sunday = rows[dt.date(2023, 1, 1)]
    assert (sunday.date_id, sunday.day_of_week, sunday.day_name, sunday.month_name, sunday.is_weekend, sunday.season) == (
        20230101, 0, "Sunday", "January", 1, "Verano")
    assert rows[dt.date(2024, 2, 29)].quarter == 1 and rows[dt.date(2023, 9, 30)].season == "Primavera"
    mixed = [d for d, r in rows.items() if r.enso_period == "Normal" and r.is_el_nino == 1]
    assert sorted(mixed) == [dt.date(2023, 5, 16) + dt.timedelta(days=i) for i in range(16)]
    assert rows[dt.date(2024, 5, 31)].enso_period == "El Niño Global" and rows[dt.date(2024, 6, 1)].is_el_nino == 0
    with pytest.raises(ValueError):
        cal.date_spine(spark, dt.date(1, 1, 1), dt.date(2024, 1, 1))


def test_spine_of_facts_covers_whole_years(spark):
    facts = spark.createDataFrame([(dt.date(1999, 5, 3),), (dt.date(2000, 1, 1),)], "date_local date")
    days = [r.date_local for r in cal.spine_of(facts).orderBy("date_local").collect()]
    assert (days[0], days[-1], len(days)) == (dt.date(1999, 1, 1), dt.date(2000, 12, 31), 731)
    assert cal.spine_of(facts.limit(0)).count() == 0


def test_time_spine_includes_its_end(spark):
    stations = spark.createDataFrame([("a",), ("b",)], "station_id string")
    out = cal.time_spine(stations, dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 3))
    assert out.count() == 2 * (2 * 48 + 1)


# --- daily and monthly ----------------------------------------------------------------------------

def observations(spark, n=6000, labels=("N", "E", "SSW", "NW"), seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = dt.datetime(2023, 1, 1) + dt.timedelta(minutes=30 * (i // 5))
        value = lambda lo, hi, p=0.03: None if rnd.random() < p else round(rnd.uniform(lo, hi), 1)
        rows.append((hot_station(rnd.randrange(50)), at, value(10, 40), value(0, 100), value(0, 30), value(0, 50),
                     rnd.choice([*labels, None]), value(990, 1020), value(0, 3, 0.2), value(0, 1200), value(0, 14), value(0, 0.3),
                     value(10, 50), value(10, 60), rnd.choice([None, None, "temp_out_of_range"])))
    return spark.createDataFrame(rows, (
        "station_id string, observation_ts timestamp_ntz, temp_out_c double, humidity_pct double, wind_speed_kmh double, "
        "wind_gust_kmh double, wind_dir string, pressure_hpa double, precip_mm double, solar_wm2 double, uv_index double, "
        "etp_mm double, heat_index_c double, thsw_index_c double, quality_flag string")).withColumns({
            "dew_point_c": F.lit(1.0), "hour": F.hour("observation_ts")})


def test_daily_summary_against_pandas(spark, plan):
    facts = star.fact_observations(observations(spark))
    assert len(facts.columns) == 19
    daily = star.fact_daily_summary(facts)
    assert len(daily.columns) == 29
    text = plan(daily)
    # readings fold in a hash aggregate; labels that are not listed meet the rest of their day in a second exchange of folded rows
    readings = text[text.rindex("Exchange hashpartitioning"):]
    assert text.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in readings and "PythonUDF" not in text
    got = daily.toPandas().set_index(["station_id", "date_local"]).sort_index()
    pdf = facts.toPandas()
    group = pdf.groupby(["station_id", "date_local"])
    half = 0.5 + 1e-9
    assert len(got) == len(group)
    assert (got["n_observations"] == group.size()).all()
    assert (got["n_flagged"] == group["quality_flag"].count()).all()
    assert np.allclose(got["temp_avg_c"], group["temp_out_c"].mean(), atol=half * 0.01, equal_nan=True)
    assert np.allclose(got["humidity_avg_pct"], group["humidity_pct"].mean(), atol=half * 0.1, equal_nan=True)
    assert np.allclose(got["precip_total_mm"], group["precip_mm"].sum(min_count=1), atol=half * 0.01, equal_nan=True)
    assert np.allclose(got["solar_daily_avg_wm2"], group["solar_wm2"].sum(min_count=1) / 48, atol=half, equal_nan=True)
    balance = group["precip_mm"].sum(min_count=1) - group["etp_mm"].sum(min_count=1)
    assert np.allclose(got["water_balance_mm"], balance, atol=half * 0.01, equal_nan=True)
    assert (got["is_hot_day"] == (group["temp_out_c"].max() > 32).astype(int)).all()
    assert (got["is_rainy_day"] == (group["precip_mm"].sum().round(6) > 2).astype(int)).all()
    assert (got["rainy_intervals"] == group["precip_mm"].apply(lambda s: (s > 0).sum())).all()

    def prevailing(s):
        counts = s.dropna().value_counts()
        return None if counts.empty else min(counts[counts == counts.max()].index)

    want = group["wind_dir"].apply(prevailing)
    assert [a if isinstance(a, str) else None for a in got["wind_dominant_dir"]] == [a if isinstance(a, str) else None for a in want]
    general = star.fact_daily_summary(facts, directions=None)
    assert sorted(map(str, general.collect())) == sorted(map(str, daily.collect()))


@pytest.mark.parametrize("directions", [("N", "S", "NE"), ("N",), None])
def test_any_direction_can_prevail(spark, directions):
    readings = {("a", 1): ["N", "SO", "SO"], ("a", 2): ["S", "S", "O", "O"], ("a", 3): ["N", "S", "O", None], ("a", 4): [None, None],
                ("b", 1): ["calm"] * 3 + ["N"] * 4, ("b", 2): ["calm"] * 4 + ["SO"] * 4 + ["NE"] * 3, ("b", 3): ["", ""]}
    base = observations(spark, 5).limit(1).drop("station_id", "observation_ts", "wind_dir")
    rows = [(s, dt.datetime(2023, 5, d, i), w) for (s, d), some in readings.items() for i, w in enumerate(some)]
    obs = spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz, wind_dir string").crossJoin(base)
    got = star.fact_daily_summary(star.fact_observations(obs), directions=directions).collect()
    assert {(r.station_id, r.date_local.day): (r.wind_dominant_dir, r.n_observations) for r in got} == {
        k: (w, len(readings[k])) for k, w in {("a", 1): "SO", ("a", 2): "O", ("a", 3): "N", ("a", 4): None, ("b", 1): "N", ("b", 2): "SO",
                                              ("b", 3): ""}.items()}


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("minutes", [30, 10, 720])
def test_gaps_of_the_range(spark, tmp_path, minutes):
    rnd = random.Random(minutes)
    step, day = dt.timedelta(minutes=minutes), dt.datetime(2023, 5, 1)
    slots = [day + i * step for i in range(5 * 1440 // minutes)]
    rows = [("a", t) for t in slots[2:-3] if rnd.random() < 0.7 and t.day not in (2, 4)] + [("b", slots[len(slots) // 2])] * 2 + [("c", slots[0]), ("d", slots[-1]), ("d", None)]
    path = str(tmp_path / "obs")
    spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz").write.parquet(path)
    obs = spark.read.parquet(path)
    seen = {r for r in rows if r[1]}
    stations = {s for s, _ in seen}
    missing = reports.missing_slots(obs, minutes)
    assert sorted(tuple(r) for r in missing.collect()) == sorted({(s, t) for s in stations for t in slots} - seen)
    whole = reports.completeness(obs, 1440 // minutes)
    got = {(r.station_id, r.date_local): r.n_observed for r in whole.collect()}
    assert got == {(s, d): sum(1 for x, t in seen if x == s and t.date() == d) for s in stations for d in {t.date() for t in slots}}
    for df in (missing, whole):  # the range comes from the exchange that the rest reads
        plan = executed(df).split("Initial Plan")[0]
        assert "ReusedExchange" in plan or "ReusedSubquery" in plan


def test_no_readings_no_gaps(spark):
    none = spark.createDataFrame([], "station_id string, observation_ts timestamp_ntz")
    assert reports.missing_slots(none).collect() == [] and reports.completeness(none).collect() == []
    with pytest.raises(ValueError):
        reports.missing_slots(none, 7)


def test_partial_day_nan_and_nulls(spark):
    base = observations(spark, 5).limit(1)
    one = base.withColumns({"temp_out_c": F.lit(float("nan")), "precip_mm": F.lit(None).cast("double"), "solar_wm2": F.lit(96.0),
                            "etp_mm": F.lit(1.0), "uv_index": F.lit(12.04), "wind_dir": F.lit(None).cast("string")})
    r = star.fact_daily_summary(star.fact_observations(one)).first()
    assert np.isnan(r.temp_avg_c) and np.isnan(r.temp_max_c) and r.is_hot_day == 1
    assert r.precip_total_mm is None and r.water_balance_mm is None and r.is_rainy_day == 0
    assert r.solar_daily_avg_wm2 == 2.0 and r.uv_max == 12.0 and r.is_uv_extreme == 1 and r.wind_dominant_dir is None


def test_monthly_equals_daily_totals(spark):
    daily = star.fact_daily_summary(star.fact_observations(observations(spark))).cache()
    monthly = star.fact_monthly_summary(daily)
    assert len(monthly.columns) == 16
    a, b = daily.agg(F.sum("n_observations"), F.sum("is_hot_day"), F.count("*")).first(), monthly.agg(
        F.sum("n_days"), F.sum("n_hot_days"), F.sum("precip_total_mm")).first()
    assert a[2] == b[0] and a[1] == b[1]
    rain = daily.agg(F.sum("precip_total_mm")).first()[0]
    assert abs(rain - b[2]) <= 0.05 * monthly.count() + 1e-6


def test_view_keeps_days_outside_the_dimensions(spark, plan):
    rows = [("STN_CN_01", dt.date(2023, 3, 1), 1.0), ("other", dt.date(1990, 1, 1), 2.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double")
    view = star.join_dimensions(daily, star.dim_station(spark), cal.dim_date(spark))
    assert len(view.columns) == 3 + 12
    got = {r.station_id: r for r in view.collect()}
    assert got["STN_CN_01"].altitude_m == 170 and got["STN_CN_01"].is_el_nino == 1
    assert got["other"].zone is None and got["other"].year is None


# --- events, numbers, ranks -----------------------------------------------------------------------

def daily_frame(spark, n=4000, seed=1):
    rnd = random.Random(seed)
    rows, seen = [], set()
    for _ in range(n):
        # One day holds a third of all rows.
        day = dt.date(2023, 1, 1) + dt.timedelta(days=0 if rnd.random() < 0.33 else rnd.randrange(100))
        key = (f"s{rnd.randrange(2000)}", day)
        if key not in seen:
            seen.add(key)
            rows.append((*key, *[rnd.choice([None, round(rnd.uniform(lo, hi), 1)]) for lo, hi in
                                 [(20, 40), (0, 30), (20, 50), (5, 15), (-12, 3)]]))
    return spark.createDataFrame(rows, (
        "station_id string, date_local date, temp_max_c double, precip_total_mm double, wind_gust_max_kmh double, uv_max double, "
        "water_balance_mm double"))


def test_events_are_numbered_like_one_sorted_list(spark, plan):
    daily = daily_frame(spark)
    pdf = daily.toPandas()
    want = []
    for rule in schema.EVENT_RULES:
        v = pdf[rule.metric]
        hit = pdf[(v > rule.threshold) if rule.op == ">" else (v < rule.threshold)]
        want += [(d, s, rule.event_type, abs(x) if rule.op == "<" else x, rule.metric, rule.description)
                 for d, s, x in zip(hit.date_local, hit.station_id, hit[rule.metric])]
    want.sort(key=lambda r: (r[0], r[1].encode(), r[2].encode()))
    events = extreme_events(daily)
    assert events.columns == ["event_id", "station_id", "date_local", "event_type", "magnitude", "metric", "description"]
    got = [(r.date_local, r.station_id, r.event_type, r.magnitude, r.metric, r.description) for r in events.orderBy("event_id").collect()]
    assert got == want
    assert [r.event_id for r in events.select("event_id").orderBy("event_id").collect()] == list(range(1, len(want) + 1))
    assert plan(detect_events(daily)).count("Scan") == 1
    assert reports.top_events(events, 5).count() == 5
    assert sum(r.n_events for r in reports.events_by_type(events, by_month=True).collect()) == len(want)


def test_event_thresholds_are_strict_and_nulls_are_no_events(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 1, 1), 33.0, 20.0, 35.0, 12.0, -7.0), ("a", dt.date(2023, 1, 2), None, None, None, None, None),
                                ("a", dt.date(2023, 1, 3), 33.1, 20.1, 35.1, 12.1, -7.1)], daily_frame(spark, 1).schema)
    rows = detect_events(df).collect()
    assert len(rows) == 5 and {r.date_local for r in rows} == {dt.date(2023, 1, 3)}
    assert {r.magnitude for r in rows} == {33.1, 20.1, 35.1, 12.1, 7.1}


def test_global_row_number_of_an_empty_frame(spark):
    assert global_row_number(spark.range(0), ["id"]).count() == 0


def test_row_number_splits_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("k"), "id")
    out = global_row_number(df, ["k", "id"], "n")
    pdf = out.toPandas().sort_values(["k", "id"])
    assert (pdf["n"].to_numpy() == np.arange(1, 30_001)).all()


def test_dense_rank_and_ties(spark):
    rows = [(c, f"s{i}", float(v)) for c in ("x", "y") for i, v in enumerate([3, 1, 3, 2, 0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "c string, s string, v double")
    got = {(r.c, r.s): r.rank for r in dense_rank_desc(df, ["c"], "v").collect()}
    assert [got[("y", f"s{i}")] for i in range(8)] == [1, 3, 1, 2, 4, 4, 4, 4]
    assert {r.s for r in dense_rank_desc(df, [], "v").filter("rank = 1").collect()} == {"s0", "s2"}
    assert sorted((r.c, r.s) for r in top_with_ties(df, ["c"], "v").collect()) == [("x", "s0"), ("x", "s2"), ("y", "s0"), ("y", "s2")]
    assert top_with_ties(df, [], "v").count() == 4


def test_event_window_factors_against_the_definition(spark, plan):
    start = dt.datetime(2023, 2, 10)
    times = [start + dt.timedelta(hours=5 * i, minutes=7 * i % 60, microseconds=250_000 * i % 1_000_000) for i in range(2400)]
    df = spark.createDataFrame([(t,) for t in times], "observation_ts timestamp_ntz")
    out = event_window_factors(df, event_windows(spark))
    text = plan(out)
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    got = out.orderBy("observation_ts").collect()
    midnight = dt.datetime.min.time()
    for r in got:
        temp, hum, mult = 0.0, 0.0, 1.0
        for _, a, b, dtemp, dhum, m in schema.EVENT_WINDOWS:
            a, b = dt.datetime.combine(a, midnight), dt.datetime.combine(b, midnight)
            outside = max((a - r.observation_ts).total_seconds(), (r.observation_ts - b).total_seconds(), 0.0) / 86400
            w = max(0.0, 1.0 - outside / 14)
            assert 0 <= w <= 1
            temp, hum, mult = temp + w * dtemp, hum + w * dhum, mult + w * (m - 1)
        assert (r.temp_anomaly, r.humidity_anomaly, r.precip_multiplier) == pytest.approx((temp, hum, mult), abs=1e-9)
    with pytest.raises(ValueError):
        window_days(event_windows(spark), 0)


# --- gap fill -------------------------------------------------------------------------------------

def fill_by_hand(values, limit):
    out, i = list(values), 0
    while i < len(out):
        if values[i] is None:
            j = i
            while j < len(values) and values[j] is None:
                j += 1
            if i > 0 and j - i <= limit:
                out[i:j] = [values[i - 1]] * (j - i)
            i = j
        else:
            i += 1
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.none(), st.none(), st.integers(0, 9).map(float)), min_size=1, max_size=60), min_size=1, max_size=4),
       st.integers(1, 3), st.integers(1, 30))
def test_forward_fill_against_a_loop(spark, stations, limit, hours):
    rows = [(f"s{k}", dt.datetime(2023, 1, 1) + dt.timedelta(hours=hours * i), v, None if v is None else v + 1)
            for k, values in enumerate(stations) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz, a double, b double")
    got = forward_fill(df, ["a", "b"], limit).toPandas().sort_values(["station_id", "observation_ts"])
    for k, values in enumerate(stations):
        mine = got[got.station_id == f"s{k}"]
        assert [None if pd.isna(x) else x for x in mine["a_filled"]] == fill_by_hand(values, limit)
        assert [None if pd.isna(x) else x for x in mine["b_filled"]] == [None if x is None else x + 1 for x in fill_by_hand(values, limit)]


def test_forward_fill_never_gathers_a_station(spark, plan):
    df = spark.createDataFrame([("s", dt.datetime(2023, 1, 1), 1.0)], "station_id string, observation_ts timestamp_ntz, a double")
    first = plan(forward_fill(df, ["a"])).split("Exchange hashpartitioning(")
    assert all("_day" in part.split(")")[0] or "station_id" in part.split(")")[0] for part in first[1:])
    assert any("_day" in part.split(")")[0] for part in first[1:])


# --- completeness ---------------------------------------------------------------------------------

def test_completeness_and_missing_slots(spark):
    t = dt.datetime
    rows = [("a", t(2023, 1, 1)), ("a", t(2023, 1, 1)), ("a", t(2023, 1, 1, 0, 30)), ("a", t(2023, 1, 3)), ("b", t(2023, 1, 2))]
    obs = spark.createDataFrame(rows, "station_id string, observation_ts timestamp_ntz")
    got = {(r.station_id, r.date_local.day): r.n_observed for r in reports.completeness(obs).collect()}
    assert got == {("a", 1): 2, ("a", 2): 0, ("a", 3): 1, ("b", 1): 0, ("b", 2): 1, ("b", 3): 0}
    missing = reports.missing_slots(obs).groupBy("station_id").count().collect()
    assert {r.station_id: r["count"] for r in missing} == {"a": 97 - 3, "b": 97 - 1}


# --- cutting lineage ------------------------------------------------------------------------------

def test_cut_lineage_deletes_what_it_shuffled(spark):
    def shuffled():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in (found.apply(i).getName() for i in range(found.size())) if x.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"), F.sum("id").alias("a.b"))
    before, was = shuffled(), spark.conf.get(setting, None)
    cut = cut_lineage(df)  # df stays in use, so that collecting garbage would not delete its files
    deadline = time.time() + 20
    while (left := shuffled() - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left and spark.conf.get(setting, None) == was
    for x in (cut, cut, df):
        assert {tuple(r) for r in x.collect()} == {(k, 10, 10 * k + 45_000) for k in range(1000)}
