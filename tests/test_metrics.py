import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from obslake.operators import calendar as cal, metrics, star
from obslake.operators.metrics import CATALOGUE, display, evaluate, evaluate_forecast, hottest_station, metrics_catalog, rank_stations
from obslake.plans import reports

D = dt.date


def make_daily(spark, seed=5, lo=D(2023, 1, 1), days=731, stations=("a", "b", "c"), keep=0.6):
    rnd = random.Random(seed)
    rows = []
    for s in stations:
        for i in range(days):
            if rnd.random() < keep and not (s == "b" and i < 200):
                rows.append((s, lo + dt.timedelta(days=i), rnd.choice([None, round(rnd.uniform(15, 30), 2)]), round(rnd.uniform(25, 40), 1),
                             round(rnd.uniform(5, 15), 1), round(rnd.uniform(30, 90), 1), round(rnd.uniform(0, 10), 2),
                             round(rnd.uniform(0, 12), 2), round(rnd.uniform(-12, 5), 2), rnd.randrange(2), rnd.randrange(2)))
    return spark.createDataFrame(rows, (
        "station_id string, date_local date, temp_avg_c double, temp_max_c double, temp_min_c double, humidity_avg_pct double, "
        "precip_total_mm double, etp_total_mm double, water_balance_mm double, is_hot_day int, is_rainy_day int")).withColumns({
            "is_windy_day": F.col("is_hot_day"), "is_uv_extreme": F.col("is_rainy_day")})


@pytest.fixture(scope="module")
def daily(spark):
    return make_daily(spark).cache()


@pytest.fixture(scope="module")
def calendar(spark):
    return cal.dim_date(spark).cache()


@pytest.fixture(scope="module")
def pandas_daily(daily, calendar):
    return daily.join(calendar, "date_local").toPandas()


def close(a, b):
    missing = pd.isna(a) or a is None, pd.isna(b) or b is None
    return all(missing) or (not any(missing) and a == pytest.approx(b, abs=1e-9))


def shifted(dates, known):
    out = set()
    for d in dates:
        try:
            out.add(d.replace(year=d.year - 1))
        except ValueError:
            out.add(D(d.year - 1, 2, 28))
        ends = (d + dt.timedelta(days=1)).day == 1
        if ends and d - dt.timedelta(days=1) in dates and d.month == 2:
            out.add(D(d.year - 1, 3, 1) - dt.timedelta(days=1))
    return out & known


def brute(pdf, calendar, by, where=None):
    """All measures per context, from the definitions, one context at a time."""
    cpdf = calendar.toPandas()
    known = set(cpdf.date_local)
    date_keys = [k for k in by if k in cpdf.columns]
    entity = [k for k in by if k not in date_keys]
    selected = cpdf if where is None else cpdf.query(where)
    contexts = [((), selected)] if not date_keys else [
        (k if isinstance(k, tuple) else (k,), g) for k, g in selected.groupby(date_keys)]
    groups = [((), pdf)] if not entity else [(k if isinstance(k, tuple) else (k,), g) for k, g in pdf.groupby(entity)]
    out = {}

    def mean(x):
        return x["temp_avg_c"].mean() if x["temp_avg_c"].count() else None

    def total(x, c):
        return x[c].sum() if len(x) else None

    normal_all = set(cpdf[cpdf.is_el_nino == 0].date_local)
    for ek, g in groups:
        for dk, c in contexts:
            dates = set(c.date_local)
            cur, ly = g[g.date_local.isin(dates)], g[g.date_local.isin(shifted(dates, known))]
            last = max(dates)
            ytd = g[(g.date_local <= last) & (g.date_local >= D(last.year, 1, 1))]
            nino, normal = (cur[cur.is_el_nino == v] for v in (1, 0))
            if cur.empty and ly.empty and ytd.empty:
                continue
            t, t_ly, h = mean(cur), mean(ly), mean(g[g.date_local.isin(normal_all)])
            sub = lambda a, b: None if a is None and b is None else (a or 0) - (b or 0)
            div = lambda a, b: None if a is None or not b else a / b
            n = len(cur) or None
            deficit = int((cur.water_balance_mm < -7).sum()) or None
            per_day = div(total(cur, "water_balance_mm"), n)
            advice = next((a for b, a in metrics.IRRIGATION_ADVICE if (per_day or 0) > b), metrics.IRRIGATION_CRITICAL)
            p, p_ly = total(cur, "precip_total_mm"), total(ly, "precip_total_mm")
            out[dict(zip(entity, ek)) and tuple(ek) + tuple(dk) or tuple(dk)] = {
                "temp_avg": t, "temp_max": cur.temp_max_c.max(), "temp_min": cur.temp_min_c.min(),
                "humidity_avg": cur.humidity_avg_pct.mean(), "precip_sum": p, "etp_sum": total(cur, "etp_total_mm"),
                "balance_sum": total(cur, "water_balance_mm"), "n_days": n, "hot_days": total(cur, "is_hot_day"),
                "hot_days_share": div(total(cur, "is_hot_day"), n), "temp_avg_ly": t_ly, "temp_delta_ly": sub(t, t_ly),
                "temp_delta_ly_share": div(sub(t, t_ly), t_ly), "precip_sum_ly": p_ly, "precip_ratio_ly": div(p, p_ly),
                "temp_ytd": mean(ytd), "precip_ytd": total(ytd, "precip_total_mm"), "etp_ytd": total(ytd, "etp_total_mm"),
                "precip_nino": total(nino, "precip_total_mm"), "precip_normal": total(normal, "precip_total_mm"),
                "temp_anomaly": sub(t, h), "etp_per_day": div(total(cur, "etp_total_mm"), n), "deficit_days": deficit,
                "deficit_days_share": div(deficit, n), "irrigation_advice": advice,
            }
    return out


MEASURES = ["temp_avg", "temp_max", "temp_min", "humidity_avg", "precip_sum", "etp_sum", "balance_sum", "n_days", "hot_days",
            "hot_days_share", "temp_avg_ly", "temp_delta_ly", "temp_delta_ly_share", "precip_sum_ly", "precip_ratio_ly", "temp_ytd",
            "precip_ytd", "etp_ytd", "precip_nino", "precip_normal", "temp_anomaly", "etp_per_day", "deficit_days",
            "deficit_days_share", "irrigation_advice"]


@pytest.mark.parametrize("by", [
    [], ["station_id"], ["year"], ["year", "month"], ["station_id", "year"], ["station_id", "year", "month"],
    ["station_id", "date_local"], ["season"], ["station_id", "season"], ["enso_period"], ["station_id", "day_of_week"],
    ["year", "day_of_month"], ["station_id", "year", "season"], ["station_id", "year", "quarter", "month_name"],
])
def test_every_measure_against_its_definition(daily, calendar, pandas_daily, by):
    want = brute(pandas_daily, calendar, by)
    got = {tuple(r[k] for k in by): r for r in evaluate(daily, MEASURES, by, calendar).collect()}
    assert set(got) == set(want)
    for key, row in want.items():
        for m in MEASURES:
            mine = got[key][m]
            assert mine == row[m] if isinstance(row[m], str) else close(mine, row[m]), (key, m, mine, row[m])


@pytest.mark.parametrize("by", [[], ["station_id"], ["year", "month"]])
def test_measures_of_selected_days(daily, calendar, pandas_daily, by):
    want = brute(pandas_daily, calendar, by, "month in (1, 2, 7)")
    got = {tuple(r[k] for k in by): r for r in evaluate(
        daily, MEASURES, by, calendar, dates=F.col("month").isin(1, 2, 7)).collect()}
    assert set(got) == set(want)
    for key, row in want.items():
        for m in MEASURES:
            assert got[key][m] == row[m] if isinstance(row[m], str) else close(got[key][m], row[m]), (key, m)


def test_year_to_date_of_days_of_the_month(spark):
    rows = [("a", D(2023, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(365)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, precip_total_mm double")
    got = {r.day_of_month: r.precip_ytd for r in evaluate(daily, ["precip_ytd"], ["year", "day_of_month"], cal.dim_date(
        spark, D(2023, 1, 1), D(2023, 12, 31))).collect()}
    assert got == {d: float((D(2023, 12, d) - D(2022, 12, 31)).days) for d in range(1, 32)} and got[5] == 339.0


def test_year_to_date_goes_on_after_the_last_reading(spark):
    rows = [("a", D(2023, m, 3), 2.0) for m in (2, 3, 4)] + [("b", D(2023, 11, 1), 1.0), (None, D(2023, 12, 31), 5.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, precip_total_mm double")
    calendar = cal.dim_date(spark, D(2022, 1, 1), D(2024, 12, 31))
    for by in (["station_id", "year", "month"], ["station_id", "month"]):  # one stretch after the other, and not
        year = {"year": [2023]} if "year" not in by else None
        rows = evaluate(daily, ["precip_sum", "precip_ytd", "n_days"], by, calendar, dates=year).collect()
        got = {(r.station_id, r.month): (r.precip_sum, r.precip_ytd, r.n_days) for r in rows}
        assert got == {("a", 2): (2.0, 2.0, 1), ("a", 3): (2.0, 4.0, 1), ("a", 4): (2.0, 6.0, 1),
                       **{("a", m): (None, 6.0, None) for m in range(5, 13)}, ("b", 11): (1.0, 1.0, 1), ("b", 12): (None, 1.0, None),
                       (None, 12): (5.0, 5.0, 1)}


@pytest.mark.parametrize("by", [[], ["year"], ["station_id", "year"], ["is_el_nino", "month"]])
def test_a_measure_replaces_the_selection_of_its_own_column(daily, calendar, pandas_daily, by):
    for flag in (0, 1):
        rows = evaluate(daily, ["precip_sum", "precip_nino", "precip_normal"], by, calendar, dates={"is_el_nino": [flag], "quarter": [1, 2, 3]}).collect()
        part = pandas_daily[pandas_daily.quarter <= 3]
        date_keys = [k for k in by if k != "station_id"]
        chosen = calendar.toPandas().query(f"is_el_nino == {flag} and quarter <= 3")
        assert rows and {tuple(r[k] for k in date_keys) for r in rows} <= {tuple(c[k] for k in date_keys) for c in chosen.to_dict("records")}
        for r in rows:
            own = part
            for k in by:
                own = own if k == "is_el_nino" else own[own[k] == r[k]]
            sums = own.groupby("is_el_nino")["precip_total_mm"].sum()
            assert close(r.precip_nino, sums.get(1)) and close(r.precip_normal, sums.get(0)) and close(r.precip_sum, sums.get(flag))
        plain = evaluate(daily, ["precip_nino", "precip_normal"], [], calendar, dates=F.col("is_el_nino") == flag).first()
        assert (plain.precip_normal is None) == (flag == 1)  # an opaque condition stays


def test_deficit_days_replace_the_selection_of_the_balance(daily, pandas_daily):
    wet = {"water_balance_mm": F.col("water_balance_mm") > 0, "station_id": ["a", "b"]}
    got = {r.station_id: r for r in evaluate(daily, ["n_days", "deficit_days", "deficit_days_share", "precip_sum"], ["station_id"], entities=wet).collect()}
    assert set(got) == {"a", "b"}
    for s, r in got.items():
        own = pandas_daily[pandas_daily.station_id == s]
        some = own[own.water_balance_mm > 0]
        deficit = int((own.water_balance_mm < -7).sum())
        assert (r.n_days, r.deficit_days) == (len(some), deficit)
        assert close(r.deficit_days_share, deficit / len(some)) and close(r.precip_sum, some.precip_total_mm.sum())


def test_missing_values_can_be_selected(spark, calendar):
    rows = [("a", D(2023, 5, 1), 1.0), (None, D(2023, 5, 2), 2.0), ("b", D(2023, 5, 3), 4.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, precip_total_mm double")
    total = lambda ids: evaluate(daily, ["precip_sum"], entities={"station_id": ids}).first().precip_sum
    assert (total(["a"]), total([None]), total(["b", None]), total([])) == (1.0, 2.0, 6.0, None)


def test_means_count_what_is_added_up(spark):
    nan = float("nan")
    daily = spark.createDataFrame([("a", D(2023, 5, d + 1), v) for d, v in enumerate((10.0, nan, None))], "station_id string, date_local date, temp_avg_c double")
    assert evaluate(daily, ["temp_avg"]).first().temp_avg == 10.0
    assert reports.month_heatmap(daily, "temp_avg_c").first().m05 == 10.0


def test_selected_entities_keep_their_filter(daily, calendar):
    some = evaluate(daily, ["temp_avg", "temp_anomaly", "precip_ytd"], ["year"], calendar, entities=F.col("station_id") == "a")
    alone = evaluate(daily.filter("station_id = 'a'"), ["temp_avg", "temp_anomaly", "precip_ytd"], ["year"], calendar)
    assert sorted(map(str, some.collect())) == sorted(map(str, alone.collect()))


def test_february_after_a_leap_year_compares_with_29_days(spark):
    rows = [("a", D(2024, 2, 28), 1.0), ("a", D(2024, 2, 29), 2.0), ("a", D(2025, 2, 28), 4.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, precip_total_mm double")
    calendar = cal.dim_date(spark, D(2024, 1, 1), D(2025, 12, 31))
    month = {(r.year, r.month): r.precip_sum_ly for r in evaluate(daily, ["precip_sum_ly"], ["year", "month"], calendar).collect()}
    assert month[(2025, 2)] == 3.0
    day = {r.date_local: r.precip_sum_ly for r in evaluate(daily, ["precip_sum_ly"], ["date_local"], calendar).collect()}
    assert day == {D(2025, 2, 28): 1.0}


def test_missing_counts_as_zero_only_on_request(spark):
    rows = [("a", D(2023, 5, 1), 20.0), ("a", D(2024, 6, 1), 25.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double")
    calendar = cal.dim_date(spark)
    for flag, first in ((True, 20.0), (False, None)):
        got = {(r.year, r.month): r for r in evaluate(
            daily, ["temp_avg", "temp_delta_ly", "temp_delta_ly_share"], ["year", "month"], calendar, blank_as_zero=flag).collect()}
        assert got[(2023, 5)].temp_delta_ly == first and got[(2023, 5)].temp_delta_ly_share is None
        assert got[(2024, 5)].temp_delta_ly == (-20.0 if flag else None)


def test_empty_fact(spark, daily, calendar):
    row = evaluate(daily.limit(0), ["temp_avg", "n_days", "hot_days_share", "irrigation_advice"], blank_as_zero=False).first()
    assert tuple(row) == (None, None, None, None)
    assert "ligero" in evaluate(daily.limit(0), ["irrigation_advice"]).first().irrigation_advice
    assert evaluate(daily.limit(0), ["temp_avg"], ["station_id"]).count() == 0


def test_flag_context_is_overridden(daily, calendar, pandas_daily):
    got = {(r.year, r.is_el_nino): r for r in evaluate(
        daily, ["precip_nino", "precip_normal", "precip_sum"], ["year", "is_el_nino"], calendar).collect()}
    for year in (2023, 2024):
        sums = pandas_daily[pandas_daily.year == year].groupby("is_el_nino")["precip_total_mm"].sum()
        for flag in (0, 1):
            r = got[(year, flag)]
            assert (r.precip_nino, r.precip_normal, r.precip_sum) == pytest.approx((sums[1], sums[0], sums[flag]))


def test_ytd_at_year_end_is_the_year(daily, calendar):
    ytd = evaluate(daily, ["temp_ytd", "precip_ytd"], ["station_id", "year", "month"], calendar).filter("month = 12")
    year = evaluate(daily, ["temp_avg", "precip_sum"], ["station_id", "year"], calendar)
    both = ytd.join(year, ["station_id", "year"]).collect()
    assert both and all(r.temp_ytd == r.temp_avg and r.precip_ytd == r.precip_sum for r in both)


def test_measures_move_with_one_shuffle_of_the_facts(daily, calendar, plan):
    text = plan(evaluate(daily, ["temp_avg", "temp_avg_ly", "precip_nino", "temp_anomaly"], ["station_id", "year"], calendar))
    assert "Cartesian" not in text and "NestedLoop" not in text and "PythonUDF" not in text
    with pytest.raises(ValueError):
        evaluate(daily, ["temp_avg_ly"], ["station_id"])
    with pytest.raises(ValueError):
        evaluate(daily, ["forecast_temp"], [])


def test_rankings(spark):
    rows = [("a", D(2023, 1, 1), 20.0, 5.0), ("b", D(2023, 1, 1), 20.0, 7.0), ("c", D(2023, 1, 1), -3.0, 1.0)]
    daily = spark.createDataFrame(rows, "station_id string, date_local date, temp_avg_c double, etp_total_mm double")
    stations = spark.createDataFrame([(s, s.upper()) for s in "abcd"], "station_id string, station_name string")
    got = {r.station_id: (r.rank_temp, r.rank_etp) for r in rank_stations(
        daily, stations, {"temp_avg": "rank_temp", "etp_sum": "rank_etp"}).collect()}
    assert got == {"a": (1, 2), "b": (1, 1), "d": (2, 4), "c": (3, 3)}
    assert hottest_station(daily, stations).first().hottest_station == "AB"
    assert hottest_station(daily, stations.where("station_id in ('c', 'd')")).first().hottest_station == "C"
    by_year = rank_stations(daily, stations, {"etp_sum": "rank_etp"}, ["year"], cal.dim_date(spark)).collect()
    assert len(by_year) == 4 and {r.year for r in by_year} == {2023}


def test_catalogue(spark):
    rows = {r.name: r for r in metrics_catalog(spark).collect()}
    assert len(rows) == len(CATALOGUE) == 36
    assert sum(r.table == "fact_forecast" for r in rows.values()) == 4
    assert rows["Δ Temp vs AA"].format == '+0.0 "°C";-0.0 "°C";0' and rows["ETP YTD"].folder == "03 Time Intelligence"
    before = CATALOGUE["temp_max"]
    try:
        metrics.define("hottest", "Temp Máxima", "x", "0", "replaced", before.needs, before.make)
        assert "temp_max" not in CATALOGUE and len(CATALOGUE) == 36
    finally:
        del CATALOGUE["hottest"]
        CATALOGUE["temp_max"] = before


@pytest.mark.parametrize("fmt,value,want", [
    ('0.0 "°C"', 21.25, "21.3 °C"), ("#,0", 12345, "12,345"), ('#,0.0 "mm"', 1234.56, "1,234.6 mm"), ("0.0 %", 0.125, "12.5 %"),
    ('0.0 "%"', 61.0, "61.0 %"), ('+0.0 "°C";-0.0 "°C";0', 1.5, "+1.5 °C"), ('+0.0 "°C";-0.0 "°C";0', -1.5, "-1.5 °C"),
    ('+0.0 "°C";-0.0 "°C";0', 0.0, "0"), ('0.0 "x"', 70.04, "70.0 x"), ("0", 3, "3"), ("0.0 %", None, None),
])
def test_display(spark, fmt, value, want):
    assert spark.range(1).select(display(F.lit(value).cast("double"), fmt).alias("x")).first().x == want


def test_formatted_evaluation(daily):
    row = evaluate(daily, ["n_days", "temp_avg"], formatted=True).first()
    assert row.n_days_text == f"{row.n_days:,}" and row.temp_avg_text.endswith(" °C")


def test_forecast_measures(spark):
    rows = [("a", "temperatura_media", 20.0, 18.0, 22.0), ("a", "temperatura_media", 22.0, 19.0, 25.0), ("a", "etp_diaria", 5.0, 4.0, 6.0)]
    fc = spark.createDataFrame(rows, "station_id string, target string, forecast_value double, forecast_lower_80 double, forecast_upper_80 double")
    row = evaluate_forecast(fc, ["forecast_temp", "forecast_etp", "forecast_temp_lower", "forecast_temp_upper"], ["station_id"]).first()
    assert tuple(row) == ("a", 21.0, 5.0, 18.5, 23.5)


def test_report_queries(spark, daily, calendar):
    assert reports.overview(daily).count() == 1
    assert reports.series(daily, ["temp_avg"]).count() == daily.count()
    monthly = star.fact_monthly_summary(daily)
    r = reports.negative_balance_months(monthly).first()
    assert r.n_months == monthly.count() and r.n_negative == monthly.filter("water_balance_mm < 0").count()
    heat = reports.month_heatmap(daily, "water_balance_mm", "sum")
    assert heat.columns == ["station_id", *[f"m{m:02d}" for m in range(1, 13)]]
    assert reports.periods_by_season(daily, calendar).agg(F.sum("n_days")).first()[0] == daily.count()
    with pytest.raises(ValueError):
        reports.month_heatmap(daily, "temp_avg_c", "median")
