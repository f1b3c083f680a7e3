import datetime as dt

import pytest
from pyspark.sql import functions as F

from obslake.operators import calendar as cal, star
from obslake.operators.enrich import FORMULAS, derive_measures
from obslake.plans import adapters
from obslake.schema import EXPORT_DECIMALS
from obslake.sources import station_text as text


def test_all_measures_inside_code_generation(spark, sf, plan):
    obs = adapters.observations(spark, sf).withColumns({"in_temp_c": F.col("temp_out_c") / 2, "in_humidity_pct": F.col("humidity_pct")})
    out = derive_measures(obs)
    assert set(FORMULAS) <= set(out.columns) and "Python" not in plan(out)
    full = derive_measures(obs, rounding=None)
    both = out.select("event_id", *[F.col(m).alias(f"r_{m}") for m in FORMULAS]).join(full, "event_id")
    for m in FORMULAS:
        worst = both.agg(F.max(F.abs(F.col(f"r_{m}") - F.col(m)))).first()[0]
        assert worst <= 0.5 * 10 ** -EXPORT_DECIMALS[m] + 1e-9, m
    assert "in_dew_c" not in derive_measures(adapters.observations(spark, sf)).columns


def test_export_cells_round_trip(spark, sf):
    obs = adapters.unique_observations(spark, sf)
    cells = text.export_cells(obs)
    row = cells.filter("Date = '01/01/24'").first()
    assert row["UV Index"] is None and "." in row["Bar"] and len(row["Time"]) == 5
    assert cells.count() == obs.count()


def test_days_without_a_calendar_row(spark):
    facts = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2030, 1, 1),)], "date_local date")
    assert [r.date_local for r in star.unmatched_days(facts, cal.dim_date(spark)).collect()] == [dt.date(2030, 1, 1)]


def test_unknown_measure(spark, sf):
    with pytest.raises(KeyError):
        derive_measures(adapters.observations(spark, sf), ["nothing"])
