"""Derived agro-meteorological measures as native column expressions.

Each function takes columns (or names) and gives a column that stays inside whole-stage code
generation.  A missing input gives a missing output wherever the formula uses it; ``_clip`` guards the
cases where Spark's ``greatest``/``least`` would skip the NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from obslake.functions.exact import col
from obslake.schema import EXPORT_DECIMALS, STEPS_PER_DAY

C = str | Column


def _clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    bounded = x
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(float(lo)))
    if hi is not None:
        bounded = F.least(bounded, F.lit(float(hi)))
    return F.when(x.isNotNull(), bounded)


def _saturation(temp: Column, at_zero: float) -> Column:
    """Tetens saturation vapour pressure, in the unit of its value at 0 °C."""
    return at_zero * F.exp(17.27 * temp / (temp + 237.3))


def dew_point_c(temp_c: C, rh_pct: C) -> Column:
    """Magnus-Tetens dew point; humidity is held between 1 and 100 %."""
    a, b = 17.625, 243.04
    t, rh = col(temp_c), _clip(col(rh_pct), 1, 100)
    gamma = F.ln(rh / 100.0) + a * t / (b + t)
    return b * gamma / (a - gamma)


def heat_index_c(temp_c: C, rh_pct: C) -> Column:
    """US weather service heat index: Steadman's simple form, Rothfusz' regression when it is hot.

    Constants and conditions as published: "The Heat Index Equation", US National Weather Service, after L. P. Rothfusz,
    technical attachment SR 90-23 (1990). Below 80 °F it is the temperature.
    """
    f = col(temp_c) * 1.8 + 32.0
    rh = col(rh_pct).cast("double")
    simple = 0.5 * (f + 61.0 + (f - 68.0) * 1.2 + rh * 0.094)

    def in_rh(c0: float, c1: float, c2: float) -> Column:
        return (rh * c2 + c1) * rh + c0

    # The nine terms, gathered by powers of the temperature: written one by one, the method outgrows what the JVM compiles.
    regression = (
        (in_rh(-0.00683783, 0.00122874, -0.00000199) * f + in_rh(2.04901523, -0.22475541, 0.00085282)) * f
        + in_rh(-42.379, 10.14333127, -0.05481717)
    )
    dry = (13.0 - rh) / 4.0 * F.sqrt(F.greatest(F.lit(0.0), (17.0 - F.abs(f - 95.0)) / 17.0))
    humid = (rh - 85.0) / 10.0 * ((87.0 - f) / 5.0)
    adjustment = (
        F.when((rh < 13) & (f <= 112), -dry).when((rh > 85) & (f <= 87), humid).otherwise(0.0)
    )
    hot = F.when((simple + f) / 2.0 >= 80, regression + adjustment).otherwise(simple)
    return F.when(f < 80, col(temp_c).cast("double")).otherwise((hot - 32.0) / 1.8)


def wind_chill_c(temp_c: C, wind_kmh: C) -> Column:
    """Wind chill where it is at most 10 °C with at least 4.8 km/h of wind, else the temperature."""
    t, v = col(temp_c), col(wind_kmh)
    v16 = F.pow(v, F.lit(0.16))
    chill = 13.12 + 0.6215 * t - 11.37 * v16 + 0.3965 * t * v16
    return F.when((t <= 10) & (v >= 4.8), chill).otherwise(t)


def thw_index_c(temp_c: C, rh_pct: C, wind_kmh: C) -> Column:
    """Heat index less the cooling by wind."""
    return heat_index_c(temp_c, rh_pct) - 1.072 * col(wind_kmh) / 10.0


def thsw_index_c(temp_c: C, rh_pct: C, wind_kmh: C, solar_wm2: C) -> Column:
    """THW plus the heating by the sun."""
    return thw_index_c(temp_c, rh_pct, wind_kmh) + col(solar_wm2) * 0.025 * 0.5


def air_density_kg_m3(temp_c: C, pressure_hpa: C, rh_pct: C) -> Column:
    """Ideal-gas density of moist air: dry part and vapour part by their own gas constants."""
    t, kelvin = col(temp_c), col(temp_c) + 273.15
    vapour = _saturation(t, 6.1078) * (col(rh_pct) / 100.0)
    return (col(pressure_hpa) - vapour) * 100.0 / (287.058 * kelvin) + vapour * 100.0 / (461.495 * kelvin)


def degree_days(temp_c: C, base_c: float = 18.0, mode: str = "heat", steps_per_day: int = STEPS_PER_DAY) -> Column:
    """Degree-days of one step, heating below or cooling above the base."""
    if mode not in ("heat", "cool"):
        raise ValueError("mode must be 'heat' or 'cool'")
    t = col(temp_c)
    return _clip(base_c - t if mode == "heat" else t - base_c, lo=0) / float(steps_per_day)


def reference_etp_mm(temp_c: C, rh_pct: C, wind_kmh: C, solar_wm2: C, pressure_hpa: C) -> Column:
    """Penman-Monteith reference evapotranspiration (FAO-56 form) of one half-hourly step."""
    t, solar = col(temp_c), col(solar_wm2)
    wind_ms = col(wind_kmh) / 3.6
    es = _saturation(t, 0.6108)
    deficit = es - es * (col(rh_pct) / 100.0)
    slope = 4098.0 * es / F.pow(t + 237.3, F.lit(2.0))
    psychrometric = 0.000665 * (col(pressure_hpa) / 10.0)
    net_mj = 0.77 * (solar * 1800.0 * 1e-6)
    kept = F.when(solar > 0, 0.9).otherwise(0.5) * net_mj
    radiative = 0.408 * slope * kept
    aerodynamic = psychrometric * (37.0 / (t + 273.0)) * wind_ms * deficit
    return _clip((radiative + aerodynamic) / (slope + psychrometric * (1.0 + 0.34 * wind_ms)), lo=0)


def wind_run_km(wind_kmh: C) -> Column:
    return col(wind_kmh) * 0.5


def solar_energy_ly(solar_wm2: C) -> Column:
    return col(solar_wm2) * 0.043


def uv_index(solar_wm2: C) -> Column:
    return _clip(col(solar_wm2) / 90.0, 0, 14)


def uv_dose_med(uv: C) -> Column:
    return col(uv) * 0.06


def rain_rate_mmh(precip_mm: C) -> Column:
    return col(precip_mm) * 2.0


def export_precision(c: str) -> Column:
    """A reading at the decimals an export keeps, half to even."""
    return F.bround(F.col(c), EXPORT_DECIMALS[c]).alias(c)
