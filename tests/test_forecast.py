import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.operators import forecast as fc

D0 = dt.date(2021, 1, 1)


def series_frame(spark, n=900, noise=0.4, seed=0, stations=("a", "b")):
    rng = np.random.default_rng(seed)
    rows = []
    for s in stations:
        for i in range(n):
            wave = 5 * np.sin(2 * np.pi * i / 365.25)
            rows.append((s, D0 + dt.timedelta(days=i), float(20 + 0.002 * i + wave + noise * rng.standard_normal()),
                         None if i % 50 == 7 else float(4 + 0.1 * wave)))
    return spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double, etp_total_mm double")


def truth(i):
    return 20 + 0.002 * i + 5 * np.sin(2 * np.pi * i / 365.25)


def test_history_is_long_and_without_gaps(spark):
    long = fc.history(series_frame(spark, 100))
    counts = {(r.station_id, r.target): r["count"] for r in long.groupBy("station_id", "target").count().collect()}
    assert counts == {("a", "temperatura_media"): 100, ("b", "temperatura_media"): 100, ("a", "etp_diaria"): 98, ("b", "etp_diaria"): 98}


def test_forecast_recovers_line_and_season(spark):
    out = fc.fact_forecast(series_frame(spark), horizon=30)
    assert out.columns == ["station_id", "forecast_date", "target", "forecast_value", "forecast_lower_80", "forecast_upper_80",
                           "model_name", "model_run_ts"]
    rows = out.filter("station_id = 'a' and target = 'temperatura_media'").orderBy("forecast_date").collect()
    assert [r.forecast_date for r in rows] == [D0 + dt.timedelta(days=900 + i) for i in range(30)]
    errors = [r.forecast_value - truth(900 + i) for i, r in enumerate(rows)]
    assert max(map(abs, errors)) < 0.6
    assert all(r.forecast_lower_80 < r.forecast_value < r.forecast_upper_80 for r in rows)
    assert out.count() == 4 * 30 and out.select("model_run_ts").distinct().count() == 1


def test_band_covers_about_four_fifths(spark):
    n, horizon, inside, total = 1100, 30, 0, 0
    rng = np.random.default_rng(7)
    day = np.arange(n + horizon, dtype=float)
    for _ in range(60):
        y = truth(day) + 0.5 * rng.standard_normal(len(day))
        _, lo, hi = fc.AdditiveModel().fit(day[:n], y[:n]).predict(day[n:])
        inside, total = inside + int(((y[n:] >= lo) & (y[n:] <= hi)).sum()), total + horizon
    assert 0.7 < inside / total < 0.9


def test_slope_change_is_followed():
    day = np.arange(1000, dtype=float)
    y = np.where(day < 400, 10 + 0.01 * day, 14 - 0.02 * (day - 400))
    value, lo, hi = fc.AdditiveModel().fit(day, y).predict(np.arange(1000.0, 1030.0))
    assert abs(value[-1] - (14 - 0.02 * 629)) < 1.0 and (lo < value).all() and (hi > value).all()


def test_band_widens_with_the_horizon():
    day = np.arange(800, dtype=float)
    y = np.where(day < 300, 0.01 * day, 3 - 0.01 * (day - 300))
    _, lo, hi = fc.AdditiveModel().fit(day, y).predict(np.arange(800.0, 1400.0))
    assert (np.diff(hi - lo) > 0).all()


@pytest.mark.parametrize("y", [np.zeros(40), np.full(40, 3.0), np.array([1.0, 2.0]), np.arange(30.0)])
def test_short_and_constant_series(y):
    value, lo, hi = fc.AdditiveModel().fit(np.arange(len(y), dtype=float), y).predict(np.arange(len(y), len(y) + 5.0))
    assert np.isfinite(value).all() and (lo <= value).all() and (value <= hi).all()
    if np.ptp(y) == 0:
        assert np.allclose(value, y[0], atol=0.05)


def test_a_failing_series_does_not_stop_the_others(spark):
    daily = series_frame(spark, 200, stations=("a",)).unionByName(
        spark.createDataFrame([("short", D0, 1.0, None)], "station_id string, date_local date, temp_avg_c double, etp_total_mm double"))
    good, failed = fc.split_failures(fc.fit_all(fc.history(daily), 7))
    assert good.count() == 2 * 7
    rows = failed.collect()
    assert [(r.station_id, r.target) for r in rows] == [("short", "temperatura_media")] and "two values" in rows[0].error
    with pytest.raises(RuntimeError):
        fc.require_some(good.limit(0))


def test_future_starts_after_the_last_value_of_each_target(spark):
    daily = series_frame(spark, 200, stations=("a",)).withColumn(
        "etp_total_mm", F.when(F.col("date_local") < F.lit(D0 + dt.timedelta(days=150)), F.col("etp_total_mm")))
    first = {r.target: r.d for r in fc.fact_forecast(daily, 3).groupBy("target").agg(F.min("forecast_date").alias("d")).collect()}
    assert first == {"temperatura_media": D0 + dt.timedelta(days=200), "etp_diaria": D0 + dt.timedelta(days=150)}


def test_summary_and_history(spark):
    daily = series_frame(spark, 400, stations=("a",))
    forecast = fc.fact_forecast(daily, 10)
    s = {r.target: r for r in fc.summary(forecast).collect()}
    assert s["etp_diaria"].n_days == 10 and s["etp_diaria"].min_lower <= s["etp_diaria"].avg_forecast <= s["etp_diaria"].max_upper
    both = fc.recent_and_forecast(fc.history(daily), forecast, days=20)
    assert both.filter("part = 'history' and target = 'temperatura_media'").count() == 20
    assert both.filter("part = 'forecast' and lower_80 is null").count() == 0


def test_yardsticks(spark):
    rows = [("a", D0 + dt.timedelta(days=i), 3.0 + 0.5 * i, None) for i in range(800)]
    long = fc.history(spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double, etp_total_mm double"))
    trend = fc.linear_trend(long, 5).orderBy("forecast_date").collect()
    assert [r.forecast_value for r in trend] == [3.0 + 0.5 * (800 + i) for i in range(5)] and trend[0].slope == 0.5
    naive = fc.seasonal_naive(long, 5).orderBy("forecast_date").collect()
    value = {D0 + dt.timedelta(days=i): 3.0 + 0.5 * i for i in range(800)}
    for r in naive:
        same = [v for d, v in value.items() if (d.month, d.day) == (r.forecast_date.month, r.forecast_date.day)]
        assert r.n_years == len(same) == 2 and r.forecast_value == pytest.approx(sum(same) / 2)
    short = fc.seasonal_naive(long.filter(F.col("ds") < F.lit(dt.date(2021, 3, 1))), 2).collect()
    assert all(r.forecast_value is None and r.n_years == 0 for r in short)


def test_trend_band_is_the_least_squares_interval(spark):
    rng = np.random.default_rng(3)
    n, horizon = 400, 60
    y = np.round(18 + 0.01 * np.arange(n + horizon) + rng.standard_normal(n + horizon), 2)
    rows = [("a", D0 + dt.timedelta(days=i), float(y[i]), float("nan")) for i in range(n)]
    rows += [("one", D0, 5.0, 1.0), ("two", D0, 5.0, None), ("two", D0 + dt.timedelta(days=3), 8.0, None)]
    long = fc.history(spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double, etp_total_mm double"))
    got = fc.trend_forecast(long, horizon)
    assert got.columns == ["station_id", "forecast_date", "target", "forecast_value", "forecast_lower_80", "forecast_upper_80", "model_name"]
    got = got.orderBy("station_id", "forecast_date").collect()
    assert {r.station_id for r in got} == {"a", "two"}
    assert [(r.forecast_value, r.forecast_lower_80) for r in got if r.station_id == "two"][:2] == [(9.0, None), (10.0, None)]
    x = np.arange(n, dtype=float)
    slope, level = np.polyfit(x, y[:n], 1)
    noise = ((y[:n] - level - slope * x) ** 2).sum() / (n - 2)
    at = np.arange(n, n + horizon)
    half = fc.Z80 * np.sqrt(noise * (1 + 1 / n + (at - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum()))
    mine = np.array([(r.forecast_value, r.forecast_lower_80, r.forecast_upper_80) for r in got if r.station_id == "a"])
    assert np.allclose(mine, np.stack([level + slope * at, level + slope * at - half, level + slope * at + half], 1), atol=1e-4)
    assert 0.65 < ((y[n:] >= mine[:, 1]) & (y[n:] <= mine[:, 2])).mean() < 0.95
    days = fc.trend_forecast(long.union(long), horizon).where("station_id = 'a'").orderBy("forecast_date").collect()
    assert days[0].forecast_value == pytest.approx(mine[0, 0]) and days[0].forecast_upper_80 < got[0].forecast_upper_80


def test_series_with_infinity_fails_alone():
    import pyarrow as pa
    from obslake.operators.forecast import _fit_series

    days = pa.array(range(20_000, 20_400), pa.int32()).cast(pa.date32())
    rows = lambda y: pa.table({"station_id": ["s"] * 400, "target": ["t"] * 400, "ds": days, "y": y})
    good = [float(i % 7) for i in range(400)]
    assert _fit_series(rows(good), 3, {})["error"].null_count == 3
    assert "not finite" in _fit_series(rows([float("inf"), *good[1:]]), 3, {})["error"][0].as_py()
