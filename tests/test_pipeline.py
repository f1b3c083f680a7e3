"""All five jobs in a row, and every registered query against its SQL."""

import datetime as dt
import os
import sys

import duckdb
import pytest

import exports
from obslake.plans import medallion
from obslake.plans.catalogue import QUERIES
from obslake.sources import tables

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
import __spark_entry__ as entry  # noqa: E402
from tools.check_oracle import TABLES, canonical, kind  # noqa: E402


def test_from_text_to_forecast(spark, tmp_path):
    raw, bronze, silver, gold = (str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold"))
    exports.write(raw, "STN_CN_01", exports.days(400))
    exports.write(raw, "STN_PA_04", exports.days(400, Rain=lambda d, i: 1.0 if d % 30 == 0 else 0.0, Hi_Speed=lambda d, i: 36.0 if d == 5 else 9.0)
                  + [exports.row("99/99/99", "00:00")])
    medallion.bronze_job(spark, raw, bronze)
    medallion.silver_job(spark, bronze, silver)
    out = medallion.gold_job(spark, silver, gold)
    counts = {r.table_name: r.n_rows for r in tables.row_counts(out).collect()}
    assert counts["dim_station"] == 4 and counts["dim_date"] == 731
    assert counts["fact_observations_30min"] == 2 * 400 * 48 and counts["fact_daily_summary"] == 800
    assert counts["fact_monthly_summary"] == 2 * 14
    assert medallion.quarantined(spark, bronze).count() == 1

    events = out["fact_extreme_events"]
    kinds = {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert kinds["Lluvia intensa"] == 14 and kinds["Vientos fuertes"] == 1
    assert [r.event_id for r in events.orderBy("event_id").collect()] == list(range(1, events.count() + 1))

    view = spark.sql("SELECT * FROM vw_daily_climate")
    assert len(view.columns) == 29 + 12 and view.filter("zone IS NULL").count() == 0
    row = spark.sql("SELECT * FROM fact_daily_summary WHERE station_id = 'STN_CN_01' AND date_local = DATE '2023-01-01'").first()
    assert (row.temp_avg_c, row.precip_total_mm, row.etp_total_mm, row.water_balance_mm, row.n_observations) == (22.35, 4.8, 4.8, 0.0, 48)
    assert row.wind_dominant_dir == "SSW" and row.solar_daily_avg_wm2 == 300.0

    forecast, failed = medallion.forecast_job(spark, gold)
    assert forecast.count() == 2 * 2 * 30 and failed.count() == 0
    assert spark.sql("SELECT min(forecast_date) AS d FROM fact_forecast").first().d == dt.date(2023, 1, 1) + dt.timedelta(days=400)

    # Running again changes nothing.
    medallion.bronze_job(spark, raw, bronze)
    medallion.silver_job(spark, bronze, silver, dt.date(2023, 2, 10), dt.date(2023, 3, 5))
    again = medallion.gold_job(spark, silver, gold)
    assert {r.table_name: r.n_rows for r in tables.row_counts(again).collect()} == counts
    medallion.register(spark, medallion.open_gold(spark, gold))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    left = df.toPandas()
    assert len(left) > 0
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    assert {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields} == {c: kind(t) for c, t in zip(rel.columns, rel.types)}
    assert canonical(left) == canonical(rel.arrow().read_all().to_pandas())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_slow_operator(spark, sf, plan, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    if not name.startswith(("forecast_additive", "forecast_summary", "forecast_kpis", "history_and_forecast")):
        assert "InPandas" not in text and "InArrow" not in text
