"""The enrichment job: derived measures next to the readings they follow from."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from obslake.functions import meteo
from obslake.schema import EXPORT_DECIMALS

_T, _RH, _V, _S, _P = "temp_out_c", "humidity_pct", "wind_speed_kmh", "solar_wm2", "pressure_hpa"

#: Measure to the readings it needs and its formula.
FORMULAS: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "dew_point_c": ((_T, _RH), meteo.dew_point_c),
    "heat_index_c": ((_T, _RH), meteo.heat_index_c),
    "wind_chill_c": ((_T, _V), meteo.wind_chill_c),
    "thw_index_c": ((_T, _RH, _V), meteo.thw_index_c),
    "thsw_index_c": ((_T, _RH, _V, _S), meteo.thsw_index_c),
    "in_air_density": ((_T, _P, _RH), meteo.air_density_kg_m3),
    "heat_dd": ((_T,), lambda t: meteo.degree_days(t, mode="heat")),
    "cool_dd": ((_T,), lambda t: meteo.degree_days(t, mode="cool")),
    "etp_mm": ((_T, _RH, _V, _S, _P), meteo.reference_etp_mm),
    "wind_run_km": ((_V,), meteo.wind_run_km),
    "solar_energy_ly": ((_S,), meteo.solar_energy_ly),
    "uv_index": ((_S,), meteo.uv_index),
    "uv_dose_med": ((_S,), lambda s: meteo.uv_dose_med(meteo.uv_index(s))),
    "precip_rate_mmh": (("precip_mm",), meteo.rain_rate_mmh),
    "in_dew_c": (("in_temp_c", "in_humidity_pct"), meteo.dew_point_c),
    "in_heat_c": (("in_temp_c", "in_humidity_pct"), meteo.heat_index_c),
}


def derive_measures(
    obs: DataFrame, measures: Sequence[str] | None = None,
    rounding: Callable[[Column, int], Column] | None = F.bround,
) -> DataFrame:
    """Add (or replace) the derived measures, at the decimals a station reports.

    Without a list, all those are added whose readings are there.  ``rounding=None`` keeps full precision.
    """
    have = set(obs.columns)
    names = [m for m, (needs, _) in FORMULAS.items() if have.issuperset(needs)] if measures is None else list(measures)
    exact = {m: FORMULAS[m][1](*FORMULAS[m][0]) for m in names}
    return obs.withColumns({m: e if rounding is None else rounding(e, EXPORT_DECIMALS[m]) for m, e in exact.items()})
