"""Names, bounds, thresholds and reference rows.

Everything here is data, passed to the operators as default parameter values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# Export column, column of the typed layer, kind, decimals kept in an export.
RAW_TO_TYPED = [
    ("Date", "date_local_str", "text", None),
    ("Time", "time_local_str", "text", None),
    ("Temp Out", "temp_out_c", "double", 1),
    ("Hi Temp", "temp_hi_c", "double", 1),
    ("Low Temp", "temp_low_c", "double", 1),
    ("Out Hum", "humidity_pct", "double", 0),
    ("Dew Pt.", "dew_point_c", "double", 1),
    ("Wind Speed", "wind_speed_kmh", "double", 1),
    ("Wind Dir", "wind_dir", "text", None),
    ("Wind Run", "wind_run_km", "double", 2),
    ("Hi Speed", "wind_gust_kmh", "double", 1),
    ("Hi Dir", "wind_gust_dir", "text", None),
    ("Wind Chill", "wind_chill_c", "double", 1),
    ("Heat Index", "heat_index_c", "double", 1),
    ("THW Index", "thw_index_c", "double", 1),
    ("THSW Index", "thsw_index_c", "double", 1),
    ("Bar", "pressure_hpa", "double", 1),
    ("Rain", "precip_mm", "double", 2),
    ("Rain Rate", "precip_rate_mmh", "double", 2),
    ("Solar Rad.", "solar_wm2", "double", 0),
    ("Solar Energy", "solar_energy_ly", "double", 2),
    ("Hi Solar Rad.", "solar_hi_wm2", "double", 0),
    ("UV Index", "uv_index", "double", 1),
    ("UV Dose", "uv_dose_med", "double", 2),
    ("Hi UV", "uv_hi", "double", 1),
    ("Heat D-D", "heat_dd", "double", 3),
    ("Cool D-D", "cool_dd", "double", 3),
    ("In Temp", "in_temp_c", "double", 1),
    ("In Hum", "in_humidity_pct", "double", 0),
    ("In Dew", "in_dew_c", "double", 1),
    ("In Heat", "in_heat_c", "double", 1),
    ("In EMC", "in_emc", "double", 2),
    ("In Air Density", "in_air_density", "double", 4),
    ("ET", "etp_mm", "double", 3),
    ("Wind Samp", "wind_samples", "int", None),
    ("Wind Tx", "wind_tx", "int", None),
    ("ISS Recept", "iss_reception_pct", "double", 1),
    ("Arc. Int.", "archive_interval_min", "int", None),
]
RAW_COLUMNS = [raw for raw, _, _, _ in RAW_TO_TYPED]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
EXPORT_DECIMALS = {typed: digits for _, typed, _, digits in RAW_TO_TYPED if digits is not None}

# First words of the two header lines, and the cells read as missing.
HEADER_DATES = ["Date", "Fecha"]
MISSING_MARK = "---"
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", MISSING_MARK,
]
# The localized header line of an export.
LOCAL_HEADER = [
    "Fecha", "Hora", "T° Out", "Hi Temp", "Low Temp", "Humedad", "Dew Pt.", "Vel. Viento (km/h)",
    "Wind Dir", "Wind Run", "Hi Speed", "Hi Dir", "Wind Chill", "Heat Index", "THW Index", "THSW Index",
    "Bar (hPa)", "Precipitacion (mm)", "Rain Rate", "Solar Rad. (W/m2)", "Solar Energy",
    "Hi Solar Rad.", "Radiacion UV", "UV Dose", "Hi UV", "Heat D-D", "Cool D-D", "In Temp", "In Hum",
    "In Dew", "In Heat", "In EMC", "In Air Density", "ETP (mm)", "Wind Samp", "Wind Tx", "ISS Recept",
    "Arc. Int.",
]

# Plausible range per reading, in order of precedence, and the flag raised outside it.
QUALITY_BOUNDS = [
    ("temp_out_c", -10, 55, "temp_out_of_range"),
    ("humidity_pct", 0, 100, "humidity_out_of_range"),
    ("pressure_hpa", 950, 1050, "pressure_out_of_range"),
    ("wind_speed_kmh", 0, 200, "wind_out_of_range"),
    ("solar_wm2", 0, 1500, "solar_out_of_range"),
]

# The sixteen compass points a station reports.
COMPASS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]

#: Half-hourly steps in a day.
STEPS_PER_DAY = 48

# A day is hot, rainy, windy or of extreme UV strictly above these.
DAY_FLAGS = {"is_hot_day": 32, "is_rainy_day": 2, "is_windy_day": 35, "is_uv_extreme": 12}

#: A day is in severe deficit strictly below this balance (mm).
SEVERE_DEFICIT_MM = -7


@dataclass(frozen=True)
class EventRule:
    """One kind of extreme event: ``metric`` beyond ``threshold`` on a day."""

    event_type: str
    metric: str
    op: str
    threshold: float
    description: str


# Event names, thresholds on the rounded daily values, and texts.
EVENT_RULES = [
    EventRule("Calor extremo", "temp_max_c", ">", 33,
              "Temperatura máxima superó 33°C, riesgo de estrés térmico en cultivos"),
    EventRule("Lluvia intensa", "precip_total_mm", ">", 20,
              "Precipitación >20mm/día, riesgo de inundación / pérdida de cosecha"),
    EventRule("Vientos fuertes", "wind_gust_max_kmh", ">", 35,
              "Ráfagas >35 km/h, riesgo mecánico en plantaciones"),
    EventRule("UV extremo", "uv_max", ">", 12,
              "Índice UV >12, riesgo para trabajadores en campo"),
    EventRule("Déficit hídrico severo", "water_balance_mm", "<", -7,
              "Demanda de agua excede 7mm sin reposición pluvial"),
]

STATION_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType(), False),
    T.StructField("station_name", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("altitude_m", T.IntegerType()),
])
# The four stations.
STATIONS = [
    ("STN_CN_01", "Estación Costa Norte", "Costa Norte semi-árida", -6.10, -79.85, 170),
    ("STN_VC_02", "Estación Valle Central", "Valle Bajo Costero", -4.95, -80.85, 80),
    ("STN_VI_03", "Estación Valle Interior", "Valle Medio Interior", -5.25, -80.55, 29),
    ("STN_PA_04", "Estación Pre-Andina", "Estribación Pre-Andina", -5.25, -79.90, 140),
]

WINDOW_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("start", T.DateType(), False),
    T.StructField("end", T.DateType(), False),
    T.StructField("temp_anomaly_c", T.DoubleType(), False),
    T.StructField("humidity_anomaly_pct", T.DoubleType(), False),
    T.StructField("precip_multiplier", T.DoubleType(), False),
])
# The two event windows and their anomalies.
EVENT_WINDOWS = [
    ("El Niño Costero 2023 (Yaku)", dt.date(2023, 3, 1), dt.date(2023, 5, 15), 2.8, 8.0, 5.5),
    ("El Niño Global 2023-2024", dt.date(2023, 6, 1), dt.date(2024, 5, 31), 1.4, 4.0, 2.2),
]
#: Days over which an event's weight ramps up before and down after its window.
RAMP_DAYS = 14

# Labels of the calendar; the flag spans both periods and the gap between them.
ENSO_PERIODS = [
    ("El Niño Costero (Yaku)", dt.date(2023, 3, 1), dt.date(2023, 5, 15)),
    ("El Niño Global", dt.date(2023, 6, 1), dt.date(2024, 5, 31)),
]
ENSO_SPAN = (dt.date(2023, 3, 1), dt.date(2024, 5, 31))
ENSO_NONE = "Normal"
CALENDAR_RANGE = (dt.date(2023, 1, 1), dt.date(2024, 12, 31))
# Southern-hemisphere seasons by month.
SEASONS = {"Verano": [12, 1, 2], "Otoño": [3, 4, 5], "Invierno": [6, 7, 8], "Primavera": [9, 10, 11]}

# Forecast targets, column of the daily fact to series name.
FORECAST_TARGETS = {"temp_avg_c": "temperatura_media", "etp_total_mm": "etp_diaria"}
FORECAST_HORIZON = 30
