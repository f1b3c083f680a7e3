import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.functions import clock, exact, meteo


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_rounding_on_the_decimal_value(spark):
    cases = [(1.005, 2, 1.01), (0.285, 2, 0.29), (2.675, 2, 2.68), (-2.5, 0, -3.0), (0.0, 2, 0.0), (12345678.125, 2, 12345678.13),
             (9.5e12, 1, 9.5e12), (-0.05, 1, -0.1)]
    row = one(spark, **{f"c{i}": exact.dround(F.lit(x), n) for i, (x, n, _) in enumerate(cases)})
    assert list(row) == [want for _, _, want in cases]


def test_rounding_gives_no_minus_zero(spark):
    row = one(spark, a=exact.dround(F.lit(-0.001), 2), b=exact.dround(F.lit(-0.0), 2),
              c=exact.round_ticks(F.lit(-3).cast("bigint"), 2), d=exact.round_mean(F.lit(-3).cast("bigint"), F.lit(2).cast("bigint"), 2))
    assert [math.copysign(1, x) for x in row] == [1, 1, 1, 1] and set(row) == {0.0}


def test_rounding_keeps_nan_and_null(spark):
    row = one(spark, a=exact.dround(F.lit(float("nan")), 2), b=exact.dround(F.lit(None).cast("double"), 2))
    assert math.isnan(row.a) and row.b is None


def test_sums_are_exact_in_any_order(spark):
    df = spark.range(100_000).select((F.col("id") % 7 * 0.1).alias("x"))
    want = sum((i % 7) for i in range(100_000)) / 10
    for n in (1, 7):
        total = df.repartition(n).agg(exact.amount(F.sum(exact.ticks("x"))).alias("s")).first().s
        assert total == want


def test_ticks_skip_what_is_no_number(spark):
    row = one(spark, a=exact.ticks(F.lit(float("nan"))), b=exact.ticks(F.lit(float("inf"))), c=exact.ticks(F.lit(0.1)))
    assert (row.a, row.b, row.c) == (None, None, 1000)


def test_round_ticks_halves_away_from_zero(spark):
    row = one(spark, a=exact.round_ticks(F.lit(10050).cast("bigint"), 2), b=exact.round_ticks(F.lit(-10050).cast("bigint"), 2),
              c=exact.round_ticks(F.lit(10049).cast("bigint"), 2))
    assert tuple(row) == (1.01, -1.01, 1.0)


@pytest.mark.parametrize("date,time,want", [
    ("01/03/23", "00:30", dt.datetime(2023, 3, 1, 0, 30)),
    ("1/3/23", "5:30", dt.datetime(2023, 3, 1, 5, 30)),
    ("31/12/68", "23:59", dt.datetime(2068, 12, 31, 23, 59)),
    ("31/12/69", "23:59", dt.datetime(1969, 12, 31, 23, 59)),
    ("29/02/24", "00:00", dt.datetime(2024, 2, 29)),
    ("29/02/23", "00:00", None), ("2023-03-01", "00:30", None), ("01/03/23", "25:00", None), ("01/03/23", None, None),
])
def test_export_stamp(spark, date, time, want):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    out = df.select(clock.parse_export_stamp("d", "t").alias("x"))
    assert out.schema["x"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().x == want


def test_local_time_does_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Lima")
        ts = dt.datetime(2024, 3, 10, 2, 47, 12)
        row = spark.range(1).select(F.lit("2024-03-10 02:47:12").cast("timestamp_ntz").alias("t")).select(
            clock.floor_to_minutes("t", 30).alias("a"), clock.day_fraction("t").alias("b"), clock.date_id("t").alias("c")).first()
        assert row.a == dt.datetime(2024, 3, 10, 2, 30) and row.c == 20240310
        assert row.b == pytest.approx((ts - dt.datetime(2024, 3, 10)).total_seconds() / 86400)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# Values by hand: published tables and direct evaluation of the formulas.
def test_dew_point(spark):
    row = one(spark, a=meteo.dew_point_c(F.lit(25.0), F.lit(100.0)), b=meteo.dew_point_c(F.lit(25.0), F.lit(50.0)),
              c=meteo.dew_point_c(F.lit(25.0), F.lit(140.0)), d=meteo.dew_point_c(F.lit(25.0), F.lit(None).cast("double")))
    assert row.a == pytest.approx(25.0) and row.b == pytest.approx(13.85, abs=0.05)
    assert row.c == pytest.approx(25.0) and row.d is None


def test_heat_index_branches(spark):
    def hi(t, rh):
        return meteo.heat_index_c(F.lit(float(t)), F.lit(float(rh)))
    row = one(spark, cool=hi(20, 90), hot=hi((96 - 32) / 1.8, 50), humid=hi((84 - 32) / 1.8, 90), dry=hi((100 - 32) / 1.8, 10))
    assert row.cool == pytest.approx(20.0)
    assert row.hot * 1.8 + 32 == pytest.approx(108, abs=1)      # heat index chart: 96 °F, 50 %
    assert row.humid * 1.8 + 32 == pytest.approx(98, abs=1.5)   # 84 °F, 90 %
    assert row.dry * 1.8 + 32 < 96


def test_wind_chill_only_in_cold_wind(spark):
    def wc(t, v):
        return meteo.wind_chill_c(F.lit(t), F.lit(v))
    row = one(spark, a=wc(-10.0, 20.0), b=wc(10.1, 20.0), c=wc(5.0, 4.7), d=wc(5.0, 4.8))
    assert row.a == pytest.approx(-17.9, abs=0.1) and row.b == 10.1 and row.c == 5.0 and row.d < 5.0


def test_air_density_and_degree_days(spark):
    row = one(spark, rho=meteo.air_density_kg_m3(F.lit(15.0), F.lit(1013.25), F.lit(0.0)),
              heat=meteo.degree_days(F.lit(6.0)), cool=meteo.degree_days(F.lit(6.0), 18.0, "cool"),
              none=meteo.degree_days(F.lit(None).cast("double")))
    assert row.rho == pytest.approx(1.225, abs=0.001)
    assert (row.heat, row.cool, row.none) == (12 / 48, 0.0, None)
    with pytest.raises(ValueError):
        meteo.degree_days(F.lit(1.0), 18.0, "other")


def test_properties_on_a_grid(spark):
    grid = spark.range(20_000).select(
        (F.col("id") % 50 - 5.0).alias("t"), (F.col("id") % 101 * 1.0).alias("h"),
        (F.col("id") % 37 * 1.0).alias("v"), (F.col("id") % 1200 * 1.0).alias("s"))
    out = grid.select(
        (meteo.dew_point_c("t", "h") - F.col("t")).alias("over"),
        meteo.reference_etp_mm("t", "h", "v", "s", F.lit(1010.0)).alias("etp"), meteo.uv_index("s").alias("uv"))
    row = out.agg(F.max("over"), F.min("etp"), F.max("etp"), F.min("uv"), F.max("uv"), F.count("etp")).first()
    assert row[0] <= 1e-9 and row[1] >= 0 and row[2] < 3 and row[3] >= 0 and row[4] <= 14 and row[5] == 20_000


def test_etp_by_hand(spark):
    t, rh, v, s, p = 28.0, 60.0, 12.0, 650.0, 1008.0
    es = 0.6108 * math.exp(17.27 * t / (t + 237.3))
    delta = 4098 * es / (t + 237.3) ** 2
    g = 0.000665 * p / 10
    rn = 0.77 * s * 1800e-6
    u = v / 3.6
    want = (0.408 * delta * (rn - 0.1 * rn) + g * 37 / (t + 273) * u * (es - es * rh / 100)) / (delta + g * (1 + 0.34 * u))
    got = one(spark, x=meteo.reference_etp_mm(F.lit(t), F.lit(rh), F.lit(v), F.lit(s), F.lit(p))).x
    assert got == pytest.approx(want, rel=1e-12)


def test_interval_measures_and_export_precision(spark):
    df = spark.createDataFrame([(0.125, 21.25, 900.0, 2.0)], "precip_mm double, temp_out_c double, s double, v double")
    row = df.select(
        meteo.export_precision("precip_mm"), meteo.export_precision("temp_out_c"), meteo.wind_run_km("v").alias("run"),
        meteo.solar_energy_ly("s").alias("ly"), meteo.uv_index("s").alias("uv"), meteo.rain_rate_mmh("precip_mm").alias("rate"),
        meteo.uv_dose_med(F.lit(10.0)).alias("dose")).first()
    assert (row.precip_mm, row.temp_out_c) == (0.12, 21.2)
    assert (row.run, row.uv, row.rate) == (1.0, 10.0, 0.25)
    assert np.isclose(row.ly, 38.7) and np.isclose(row.dose, 0.6)
