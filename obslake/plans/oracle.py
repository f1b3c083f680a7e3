"""The registered queries as plain SQL for an independent engine, over the same tables."""

from __future__ import annotations

import datetime as dt

from obslake.plans import adapters as ad
from obslake.schema import EVENT_RULES

ORACLE: dict[str, str] = {}


# Building blocks --------------------------------------------------------------------------------

def rnd(x: str, n: int = 6) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def rdec(x: str, n: int) -> str:
    """Round an exact sum."""
    return f"CAST(round({x}, {n}) AS DOUBLE)"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def total(x: str) -> str:
    return f"CAST(sum({dec(x)}) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / NULLIF(count({x}), 0))"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def integer(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def day(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"


def date_id(x: str) -> str:
    return integer(f"strftime({x}, '%Y%m%d')")


# Adapters ---------------------------------------------------------------------------------------

OBS = """obs AS (
  SELECT event_id, 'STN_0' || CAST(stn AS VARCHAR) AS station_id, ts AS event_ts,
    time_bucket(INTERVAL 30 MINUTE, ts) AS observation_ts,
    CAST(CASE WHEN event_id % 331 = 0 THEN NULL WHEN event_id % 499 = 1 THEN 99.0 ELSE 15 + (v % 200) / 10.0 END AS DOUBLE) AS temp_out_c,
    CAST(CASE WHEN event_id % 337 = 0 THEN NULL WHEN event_id % 503 = 1 THEN 101.0 ELSE 30 + v % 71 END AS DOUBLE) AS humidity_pct,
    CAST((event_id * 7 % 300) / 10.0 AS DOUBLE) AS wind_speed_kmh,
    CAST((event_id * 7 % 300) / 10.0 + v % 12 AS DOUBLE) AS wind_gust_kmh,
    ['N','NE','E','SE','S','SW','W','NW'][CAST(event_id % 8 AS INTEGER) + 1] AS wind_dir,
    CAST(1000 + v % 20 AS DOUBLE) AS pressure_hpa,
    CAST(CASE WHEN event_type = 'signup' THEN (v % 50) / 10.0 ELSE 0 END AS DOUBLE) AS precip_mm,
    CAST(CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN v % 1100 ELSE 0 END AS DOUBLE) AS solar_wm2
  FROM (SELECT event_id, event_type, ts, CAST(user_id % 4 + 1 AS INTEGER) AS stn, CAST(round(value * 100) AS BIGINT) AS v FROM events)
)"""

UNIQUE = OBS + """, uniq AS (
  SELECT o.* FROM obs o
  JOIN (SELECT min(event_id) AS event_id FROM obs GROUP BY station_id, observation_ts) k ON o.event_id = k.event_id
)"""

FLAG = """CASE WHEN NOT (temp_out_c BETWEEN -10 AND 55) THEN 'temp_out_of_range'
  WHEN NOT (humidity_pct BETWEEN 0 AND 100) THEN 'humidity_out_of_range'
  WHEN NOT (pressure_hpa BETWEEN 950 AND 1050) THEN 'pressure_out_of_range'
  WHEN NOT (wind_speed_kmh BETWEEN 0 AND 200) THEN 'wind_out_of_range'
  WHEN NOT (solar_wm2 BETWEEN 0 AND 1500) THEN 'solar_out_of_range' END"""


def dew(t: str, h: str) -> str:
    g = f"(ln(least(greatest({h}, 1.0), 100.0) / 100.0) + 17.625 * ({t}) / (243.04 + ({t})))"
    return f"CASE WHEN ({h}) IS NOT NULL THEN 243.04 * {g} / (17.625 - {g}) END"


def heat(t: str, h: str) -> str:
    f = f"(({t}) * 9.0 / 5.0 + 32.0)"
    simple = f"(0.5 * ({f} + 61.0 + ({f} - 68.0) * 1.2 + ({h}) * 0.094))"
    full = (f"(-42.379 + 2.04901523 * {f} + 10.14333127 * ({h}) - 0.22475541 * {f} * ({h}) - 0.00683783 * {f} * {f} "
            f"- 0.05481717 * ({h}) * ({h}) + 0.00122874 * {f} * {f} * ({h}) + 0.00085282 * {f} * ({h}) * ({h}) "
            f"- 0.00000199 * {f} * {f} * ({h}) * ({h}))")
    low = f"((13.0 - ({h})) / 4.0 * sqrt(greatest(0.0, (17.0 - abs({f} - 95.0)) / 17.0)))"
    high = f"((({h}) - 85.0) / 10.0 * ((87.0 - {f}) / 5.0))"
    return (f"((CASE WHEN {f} < 80 THEN {f} WHEN ({simple} + {f}) / 2.0 >= 80 THEN "
            f"{full} - (CASE WHEN ({h}) < 13 AND {f} >= 80 AND {f} <= 112 THEN {low} ELSE 0.0 END) "
            f"+ (CASE WHEN ({h}) > 85 AND {f} >= 80 AND {f} <= 87 THEN {high} ELSE 0.0 END) "
            f"ELSE {simple} END) - 32.0) * 5.0 / 9.0")


def etp() -> str:
    es = "(0.6108 * exp(17.27 * temp_out_c / (temp_out_c + 237.3)))"
    slope = f"(4098.0 * {es} / power(temp_out_c + 237.3, 2.0))"
    gamma = "(0.000665 * (pressure_hpa / 10.0))"
    wind = "(wind_speed_kmh / 3.6)"
    net = "((CASE WHEN solar_wm2 > 0 THEN 0.9 ELSE 0.5 END) * (0.77 * (solar_wm2 * 1800.0 * 1e-6)))"
    value = (f"((0.408 * {slope} * {net} + {gamma} * (37.0 / (temp_out_c + 273.0)) * {wind} * ({es} - {es} * (humidity_pct / 100.0))) "
             f"/ ({slope} + {gamma} * (1.0 + 0.34 * {wind})))")
    return f"CASE WHEN {value} IS NOT NULL THEN greatest(0.0, {value}) END"


THW = f"({heat('temp_out_c', 'humidity_pct')} - 1.072 * wind_speed_kmh / 10.0)"
THSW = f"({THW} + solar_wm2 * 0.025 * 0.5)"
UV = "CASE WHEN solar_wm2 IS NOT NULL THEN least(greatest(solar_wm2 / 90.0, 0.0), 14.0) END"

FACT_OBS = UNIQUE + f""", fact AS (
  SELECT station_id, observation_ts, {date_id('observation_ts')} AS date_id, CAST(observation_ts AS DATE) AS date_local,
    {integer('hour(observation_ts)')} AS hour, temp_out_c, humidity_pct,
    {rnd(dew('temp_out_c', 'humidity_pct'), 1)} AS dew_point_c, wind_speed_kmh, wind_gust_kmh, wind_dir, pressure_hpa, precip_mm, solar_wm2,
    {rnd(UV, 1)} AS uv_index, {rnd(etp(), 3)} AS etp_mm, {rnd(heat('temp_out_c', 'humidity_pct'), 1)} AS heat_index_c,
    {rnd(THSW, 1)} AS thsw_index_c, {FLAG} AS quality_flag
  FROM uniq
)"""

OBS_DAY = FACT_OBS + f""", prevailing AS (
  SELECT station_id, date_local, wind_dir FROM (
    SELECT station_id, date_local, wind_dir, row_number() OVER (PARTITION BY station_id, date_local ORDER BY count(*) DESC, wind_dir) AS rn
    FROM fact WHERE wind_dir IS NOT NULL GROUP BY station_id, date_local, wind_dir) WHERE rn = 1
), obs_day AS (
  SELECT f.station_id, f.date_local, min(f.date_id) AS date_id,
    {rnd(mean('temp_out_c'), 2)} AS temp_avg_c, {rnd('max(temp_out_c)', 2)} AS temp_max_c, {rnd('min(temp_out_c)', 2)} AS temp_min_c,
    {rnd('max(temp_out_c) - min(temp_out_c)', 2)} AS temp_amplitude_c,
    {rnd(mean('humidity_pct'), 1)} AS humidity_avg_pct, {rnd('min(humidity_pct)', 0)} AS humidity_min_pct, {rnd('max(humidity_pct)', 0)} AS humidity_max_pct,
    {rnd(mean('wind_speed_kmh'), 1)} AS wind_avg_kmh, {rnd('max(wind_gust_kmh)', 1)} AS wind_gust_max_kmh,
    any_value(p.wind_dir) AS wind_dominant_dir,
    {rdec('sum(' + dec('precip_mm') + ')', 2)} AS precip_total_mm, count(*) FILTER (WHERE precip_mm > 0) AS rainy_intervals,
    {rnd('max(solar_wm2)', 0)} AS solar_max_wm2, {rnd(total('solar_wm2') + ' / 48.0', 0)} AS solar_daily_avg_wm2, {rnd('max(uv_index)', 1)} AS uv_max,
    {rdec('sum(' + dec('etp_mm') + ')', 2)} AS etp_total_mm,
    {rdec('sum(' + dec('precip_mm') + ') - sum(' + dec('etp_mm') + ')', 2)} AS water_balance_mm,
    {rnd('max(heat_index_c)', 1)} AS heat_index_max_c, {rnd('max(thsw_index_c)', 1)} AS thsw_max_c, {rnd(mean('pressure_hpa'), 1)} AS pressure_avg_hpa,
    count(*) AS n_observations, count(quality_flag) AS n_flagged,
    {integer('coalesce(max(temp_out_c) > 32, false)')} AS is_hot_day,
    {integer('coalesce(sum(' + dec('precip_mm') + ') > 2, false)')} AS is_rainy_day,
    {integer('coalesce(max(wind_gust_kmh) > 35, false)')} AS is_windy_day,
    {integer('coalesce(max(uv_index) > 12, false)')} AS is_uv_extreme
  FROM fact f LEFT JOIN prevailing p ON f.station_id = p.station_id AND f.date_local = p.date_local
  GROUP BY f.station_id, f.date_local
)"""

DIM = """dim AS (
  SELECT 'STN_' || CAST(s.s_suppkey AS VARCHAR) AS station_id, s.s_name AS station_name, n.n_name AS zone, r.r_name AS region,
    CAST(s.s_suppkey % 180 - 90 AS DOUBLE) AS latitude, CAST(s.s_suppkey % 360 - 180 AS DOUBLE) AS longitude,
    CAST(s.s_suppkey % 4000 AS INTEGER) AS altitude_m
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DLY = f"""dly AS (
  SELECT 'STN_' || CAST(l_suppkey AS VARCHAR) AS station_id, CAST(l_shipdate AS DATE) AS date_local,
    {rnd('CAST(sum(' + dec('l_quantity') + ') AS DOUBLE) / count(*)', 2)} AS temp_avg_c,
    max(l_quantity) AS temp_max_c, min(l_quantity) AS temp_min_c,
    {rdec('sum(' + dec('l_discount*100') + ')', 2)} AS precip_total_mm, {rdec('sum(' + dec('l_tax*100') + ')', 2)} AS etp_total_mm,
    {rdec('sum(' + dec('l_discount*100') + ') - sum(' + dec('l_tax*100') + ')', 2)} AS water_balance_mm,
    {rnd('CAST(sum(l_linenumber) * 10 AS DOUBLE) / count(*)', 1)} AS humidity_avg_pct,
    {integer('max(l_quantity) > 45')} AS is_hot_day, {integer('sum(' + dec('l_discount*100') + ') > 2')} AS is_rainy_day,
    {integer('max(l_linenumber) > 5')} AS is_windy_day, {integer('max(' + dec('l_discount*100') + ') > 9')} AS is_uv_extreme,
    count(*) AS n_observations
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
)"""


def _label() -> str:
    whens = " ".join(f"WHEN date_local BETWEEN {day(a)} AND {day(b)} THEN '{n}'" for n, a, b in ad.PERIODS)
    return f"CASE {whens} ELSE 'Normal' END"


CAL = f"""cal AS (
  SELECT date_local, {date_id('date_local')} AS date_id, {integer('year(date_local)')} AS year, {integer('quarter(date_local)')} AS quarter,
    {integer('month(date_local)')} AS month, monthname(date_local) AS month_name, {integer('day(date_local)')} AS day_of_month,
    {integer('dayofweek(date_local)')} AS day_of_week, dayname(date_local) AS day_name,
    {integer('dayofweek(date_local) IN (0, 6)')} AS is_weekend,
    CASE WHEN month(date_local) IN (12, 1, 2) THEN 'Verano' WHEN month(date_local) BETWEEN 3 AND 5 THEN 'Otoño'
         WHEN month(date_local) BETWEEN 6 AND 8 THEN 'Invierno' ELSE 'Primavera' END AS season,
    {_label()} AS enso_period, {integer(f'date_local BETWEEN {day(ad.SPAN[0])} AND {day(ad.SPAN[1])}')} AS is_el_nino
  FROM (SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date_local
        FROM (SELECT year(min(l_shipdate)) AS lo, year(max(l_shipdate)) AS hi FROM lineitem))
)"""

MONTHLY = f"""monthly AS (
  SELECT station_id, {integer('year(date_local)')} AS year, {integer('month(date_local)')} AS month,
    CAST(date_trunc('month', date_local) AS DATE) AS month_start,
    {rnd(mean('temp_avg_c'), 2)} AS temp_avg_c, {rnd('max(temp_max_c)', 2)} AS temp_max_c, {rnd('min(temp_min_c)', 2)} AS temp_min_c,
    {rnd(mean('humidity_avg_pct'), 1)} AS humidity_avg_pct,
    {rdec('sum(' + dec('precip_total_mm') + ')', 1)} AS precip_total_mm, {rdec('sum(' + dec('etp_total_mm') + ')', 1)} AS etp_total_mm,
    {rdec('sum(' + dec('water_balance_mm') + ')', 1)} AS water_balance_mm,
    {big('sum(is_hot_day)')} AS n_hot_days, {big('sum(is_rainy_day)')} AS n_rainy_days,
    {big('sum(is_windy_day)')} AS n_windy_days, {big('sum(is_uv_extreme)')} AS n_uv_extreme_days, count(*) AS n_days
  FROM dly GROUP BY ALL
)"""


def _union_events(source: str, rules) -> str:
    parts = []
    for r in rules:
        size = r.metric if r.op == ">" else f"abs({r.metric})"
        parts.append(f"SELECT station_id, date_local, '{r.event_type}' AS event_type, CAST({size} AS DOUBLE) AS magnitude, "
                     f"'{r.metric}' AS metric, '{r.description}' AS description FROM {source} WHERE {r.metric} {r.op} {r.threshold}")
    return " UNION ALL ".join(parts)


EV = DLY + f", ev AS ({_union_events('dly', ad.DAILY_RULES)})"

# A context's days one year earlier: shifted days, and the month's end where its last two days are held.
SAME_DAYS = """cur AS (SELECT {k}, date_local FROM cal),
ly AS (
  SELECT DISTINCT {k}, d AS date_local FROM (
    SELECT {k}, CAST(date_local - INTERVAL 1 YEAR AS DATE) AS d FROM cur
    UNION ALL
    SELECT {k}, CAST(last_day(CAST(last_day(date_local) - INTERVAL 1 YEAR AS DATE)) AS DATE) AS d FROM cur
    WHERE last_day(date_local) - date_local <= 1 GROUP BY {k}, last_day(date_local) HAVING count(*) = 2)
  WHERE d IN (SELECT date_local FROM cal)
)"""


def minus(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL OR {b} IS NOT NULL THEN coalesce({a}, 0) - coalesce({b}, 0) END"


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# Ingestion and typing ---------------------------------------------------------------------------

ORACLE["station_exports"] = _with(OBS) + f"""
SELECT station_id, CAST(event_ts AS DATE) AS date_local, count(*) AS n_rows, count(temp_out_c) AS n_temp,
  {total('temp_out_c')} AS temp_sum, max(humidity_pct) AS humidity_max, min(wind_dir) AS wind_dir_min
FROM obs GROUP BY ALL"""

_BAD = " UNION ALL ".join(
    f"SELECT station_id, '{kind}' AS kind, count(*) AS n_lines FROM obs WHERE event_id % {n} = 0 GROUP BY station_id"
    for n, kind in ((97, "no_row"), (101, "too_many_cells"), (103, "bad_instant"), (107, "row"), (109, "no_row")))
ORACLE["quarantine_counts"] = _with(OBS) + f"""
SELECT station_id, kind, {big('sum(n_lines)')} AS n_lines FROM (
  SELECT station_id, 'row' AS kind, count(*) AS n_lines FROM obs GROUP BY station_id
  UNION ALL SELECT DISTINCT station_id, 'header', 2 FROM obs UNION ALL SELECT DISTINCT station_id, 'name', 1 FROM obs
  UNION ALL {_BAD}) GROUP BY ALL"""

ORACLE["silver_typed"] = _with(OBS) + """
SELECT station_id, date_trunc('minute', event_ts) AS observation_ts, strftime(event_ts, '%d/%m/%y') AS date_local_str,
  strftime(event_ts, '%H:%M') AS time_local_str, temp_out_c, humidity_pct, wind_speed_kmh, wind_gust_kmh, wind_dir,
  pressure_hpa, precip_mm, solar_wm2 FROM obs"""

ORACLE["silver_dedup"] = _with(UNIQUE) + "SELECT * FROM uniq"

ORACLE["quality_flags"] = _with(UNIQUE) + f"""
SELECT station_id, {FLAG} AS quality_flag, count(*) AS n_rows FROM uniq GROUP BY ALL"""

ORACLE["quality_flag_rows"] = _with(OBS) + f"""
SELECT event_id, {FLAG} AS quality_flag, {integer('year(observation_ts)')} AS year, {integer('month(observation_ts)')} AS month,
  {integer('day(observation_ts)')} AS day, {integer('hour(observation_ts)')} AS hour FROM obs"""

ORACLE["silver_profile"] = _with(UNIQUE) + f"""
SELECT station_id, count(*) AS n_rows, min(observation_ts) AS first_ts, max(observation_ts) AS last_ts, count({FLAG}) AS flagged
FROM uniq GROUP BY station_id ORDER BY station_id"""

ORACLE["silver_totals"] = _with(UNIQUE) + f"""
SELECT count(*) AS n_rows, count({FLAG}) AS flagged,
  {rnd(f'CAST(count({FLAG}) * 100 AS DOUBLE) / count(*)', 2)} AS flagged_pct FROM uniq"""

ORACLE["bronze_partitions"] = """
SELECT 'STN_' || CAST(l_suppkey AS VARCHAR) AS station_id, count(DISTINCT year(l_shipdate) * 100 + month(l_shipdate)) AS n_partitions
FROM lineitem GROUP BY l_suppkey"""


def _fill(m: str) -> tuple[str, str]:
    island = f"count({m}) OVER (PARTITION BY station_id ORDER BY observation_ts) AS i_{m}"
    out = (f"CASE WHEN {m} IS NULL AND count(*) FILTER (WHERE {m} IS NULL) OVER (PARTITION BY station_id, i_{m}) <= 2 "
           f"THEN max({m}) OVER (PARTITION BY station_id, i_{m}) ELSE {m} END AS {m}_filled")
    return island, out


_T, _H = _fill("temp_out_c"), _fill("humidity_pct")
ORACLE["forward_fill_short_gaps"] = _with(UNIQUE) + f"""
SELECT station_id, observation_ts, temp_out_c, humidity_pct, {_T[1]}, {_H[1]}
FROM (SELECT station_id, observation_ts, temp_out_c, humidity_pct, {_T[0]}, {_H[0]} FROM uniq)"""

# Dimensions and facts ---------------------------------------------------------------------------

ORACLE["dim_date"] = _with(CAL) + "SELECT * FROM cal"
ORACLE["dim_station"] = _with(DIM) + "SELECT * FROM dim"
ORACLE["station_key_check"] = _with(DIM) + """
SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT station_id FROM dim GROUP BY 1 HAVING count(*) > 1)) AS n_repeated_keys FROM dim"""
ORACLE["stations_without_data"] = _with(DIM) + """
SELECT station_id FROM dim EXCEPT
SELECT 'STN_' || CAST(l_suppkey AS VARCHAR) FROM lineitem
WHERE CAST(l_shipdate AS DATE) = (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)"""
ORACLE["fact_observations"] = _with(FACT_OBS) + "SELECT * FROM fact"
ORACLE["fact_daily_summary"] = _with(OBS_DAY) + "SELECT * FROM obs_day"
ORACLE["daily_directions_any"] = _with(UNIQUE) + """
SELECT station_id, date_local, wind_dominant_dir FROM (
  SELECT station_id, CAST(observation_ts AS DATE) AS date_local, d AS wind_dominant_dir,
    row_number() OVER (PARTITION BY station_id, CAST(observation_ts AS DATE) ORDER BY count(*) DESC, d) AS rn
  FROM (SELECT *, CASE wind_dir WHEN 'W' THEN 'O' WHEN 'SW' THEN 'SO' WHEN 'NW' THEN 'NO' ELSE wind_dir END AS d FROM uniq)
  GROUP BY station_id, CAST(observation_ts AS DATE), d) WHERE rn = 1"""
ORACLE["fact_monthly_summary"] = _with(DLY, MONTHLY) + "SELECT * FROM monthly"
ORACLE["daily_view"] = _with(DLY, DIM, CAL) + """
SELECT f.*, s.station_name, s.zone, s.latitude, s.longitude, s.altitude_m,
  d.year, d.quarter, d.month, d.month_name, d.season, d.enso_period, d.is_el_nino
FROM dly f LEFT JOIN dim s ON f.station_id = s.station_id LEFT JOIN cal d ON f.date_local = d.date_local"""
ORACLE["gold_row_counts"] = _with(UNIQUE, EV, DIM, CAL, MONTHLY) + """
SELECT 'dim_station' AS table_name, count(*) AS n_rows FROM dim UNION ALL SELECT 'dim_date', count(*) FROM cal
UNION ALL SELECT 'fact_observations_30min', count(*) FROM uniq UNION ALL SELECT 'fact_daily_summary', count(*) FROM dly
UNION ALL SELECT 'fact_monthly_summary', count(*) FROM monthly UNION ALL SELECT 'fact_extreme_events', count(*) FROM ev"""

# Events -----------------------------------------------------------------------------------------

ORACLE["extreme_event_hits"] = _with(EV) + "SELECT * FROM ev"
ORACLE["extreme_event_ids"] = _with(EV) + """
SELECT row_number() OVER (ORDER BY date_local, station_id, event_type) AS event_id, * FROM ev"""
ORACLE["extreme_events_of_observations"] = _with(OBS_DAY) + _union_events("obs_day", EVENT_RULES)
ORACLE["top_events"] = _with(EV) + "SELECT * FROM ev ORDER BY magnitude DESC NULLS LAST, date_local, station_id, event_type LIMIT 25"
ORACLE["events_by_type"] = _with(EV) + "SELECT event_type, count(*) AS n_events FROM ev GROUP BY 1"
ORACLE["events_by_type_and_month"] = _with(EV) + f"""
SELECT event_type, {integer('month(date_local)')} AS month, count(*) AS n_events FROM ev GROUP BY ALL"""

_WINDOWS = ", ".join(
    f"({day(a)}, {day(b)}, CAST({t} AS DOUBLE), CAST({h} AS DOUBLE), CAST({p} AS DOUBLE))" for _, a, b, t, h, p in ad.OBS_WINDOWS)
_BEFORE = "((epoch_us(CAST(w.a AS TIMESTAMP)) - epoch_us(e.ts)) / 86400000000.0)"
_AFTER = "((epoch_us(e.ts) - epoch_us(CAST(w.b AS TIMESTAMP))) / 86400000000.0)"
ORACLE["event_window_weights"] = f"""
WITH w(a, b, t, h, p) AS (VALUES {_WINDOWS}),
j AS (
  SELECT e.event_id, e.ts, w.t, w.h, w.p,
    CASE WHEN e.ts BETWEEN w.a AND w.b THEN 1.0 WHEN {_BEFORE} > 0 THEN 1.0 - {_BEFORE} / 7 ELSE 1.0 - {_AFTER} / 7 END AS x
  FROM events e LEFT JOIN w ON e.ts BETWEEN w.a - INTERVAL 7 DAY AND w.b + INTERVAL 7 DAY
)
SELECT event_id, ts AS observation_ts, {rnd('coalesce(sum(x * t), 0)')} AS temp_anomaly,
  {rnd('coalesce(sum(x * h), 0)')} AS humidity_anomaly, {rnd('1 + coalesce(sum(x * (p - 1)), 0)')} AS precip_multiplier
FROM j GROUP BY event_id, ts"""

# Derived measures -------------------------------------------------------------------------------


def _derived(name: str, columns: dict[str, str]) -> None:
    items = ", ".join(f"{rnd(e)} AS {k}" for k, e in columns.items())
    ORACLE[name] = _with(OBS) + f"SELECT event_id, {items} FROM obs"


_T_IN, _H_IN = "(temp_out_c * 0.5 + 12)", "(humidity_pct * 0.5 + 20)"
_COLD = "(temp_out_c - 15)"
_V16 = "power(wind_speed_kmh, 0.16)"
_VAPOUR = "(6.1078 * exp(17.27 * temp_out_c / (temp_out_c + 237.3)) * (humidity_pct / 100.0))"
_derived("derived_dew_point", {"dew_point_c": dew("temp_out_c", "humidity_pct")})
_derived("derived_heat_index", {"heat_index_c": heat("temp_out_c", "humidity_pct")})
_derived("derived_heat_index_extremes", {
    "heat_index_hot_c": heat("(temp_out_c + 15)", "humidity_pct"), "heat_index_dry_c": heat("(temp_out_c + 15)", "(humidity_pct / 5)")})
_derived("derived_wind_chill", {"wind_chill_c": (
    f"CASE WHEN {_COLD} <= 10 AND wind_speed_kmh >= 4.8 THEN 13.12 + 0.6215 * {_COLD} - 11.37 * {_V16} + 0.3965 * {_COLD} * {_V16} "
    f"ELSE {_COLD} END")})
_derived("derived_thw", {"thw_index_c": THW})
_derived("derived_thsw", {"thsw_index_c": THSW})
_derived("derived_air_density", {"in_air_density": (
    f"(pressure_hpa - {_VAPOUR}) * 100.0 / (287.058 * (temp_out_c + 273.15)) + {_VAPOUR} * 100.0 / (461.495 * (temp_out_c + 273.15))")})
_derived("derived_degree_days", {
    "heat_dd": "CASE WHEN temp_out_c < 18 THEN (18.0 - temp_out_c) / 48.0 WHEN temp_out_c >= 18 THEN 0.0 END",
    "cool_dd": "CASE WHEN temp_out_c > 18 THEN (temp_out_c - 18.0) / 48.0 WHEN temp_out_c <= 18 THEN 0.0 END"})
_derived("derived_etp", {"etp_mm": etp()})
_derived("derived_interval_measures", {
    "wind_run_km": "wind_speed_kmh * 0.5", "solar_energy_ly": "solar_wm2 * 0.043", "uv_index": UV,
    "uv_dose_med": f"({UV}) * 0.06", "precip_rate_mmh": "precip_mm * 2"})
_derived("derived_indoor", {"in_dew_c": dew(_T_IN, _H_IN), "in_heat_c": heat(_T_IN, _H_IN)})

# Metric layer -----------------------------------------------------------------------------------

ORACLE["kpis_core"] = _with(DLY) + f"""
SELECT {rnd(mean('temp_avg_c'))} AS temp_avg, {rnd('max(temp_max_c)')} AS temp_max, {rnd('min(temp_min_c)')} AS temp_min,
  {rnd(mean('humidity_avg_pct'))} AS humidity_avg, {rnd(total('precip_total_mm'))} AS precip_sum, {rnd(total('etp_total_mm'))} AS etp_sum,
  {rnd(total('water_balance_mm'))} AS balance_sum, NULLIF(count(*), 0) AS n_days FROM dly"""

ORACLE["kpis_extremes"] = _with(DLY) + f"""
SELECT station_id, {big('sum(is_hot_day)')} AS hot_days, {big('sum(is_rainy_day)')} AS rainy_days, {big('sum(is_windy_day)')} AS windy_days,
  {big('sum(is_uv_extreme)')} AS uv_days, {rnd('CAST(sum(is_hot_day) AS DOUBLE) / count(*)')} AS hot_days_share
FROM dly GROUP BY station_id"""


def _yoy(date_keys: str, entity: str, columns: str) -> str:
    k = ", ".join(x for x in (entity, date_keys) if x)
    agg = f"{mean('temp_avg_c')} AS t, {total('precip_total_mm')} AS p"
    return _with(DLY, CAL, SAME_DAYS.format(k=date_keys)) + f""",
a AS (SELECT {k}, {agg} FROM dly JOIN cur USING (date_local) GROUP BY {k}),
b AS (SELECT {k}, {agg} FROM dly JOIN ly USING (date_local) GROUP BY {k}),
m AS (SELECT {k}, a.t, a.p, b.t AS t_ly, b.p AS p_ly FROM a FULL JOIN b USING ({k}))
SELECT {k}, {columns} FROM m"""


_DELTA = minus("t", "t_ly")
_YOY = {
    "temp_avg": rnd("t"), "temp_avg_ly": rnd("t_ly"), "temp_delta_ly": rnd(_DELTA),
    "temp_delta_ly_share": rnd(f"({_DELTA}) / NULLIF(t_ly, 0)"), "precip_sum": rnd("p"), "precip_sum_ly": rnd("p_ly"),
    "precip_ratio_ly": rnd("p / NULLIF(p_ly, 0)"),
}


def _pick(*names: str) -> str:
    return ", ".join(f"{_YOY[n]} AS {n}" for n in names)


ORACLE["yoy_by_month"] = _yoy("year, month", "", _pick(*_YOY))
ORACLE["yoy_by_station_year"] = _yoy("year", "station_id", _pick("temp_avg", "temp_avg_ly", "temp_delta_ly", "precip_ratio_ly"))
ORACLE["rain_by_month"] = _yoy("year, month", "", _pick("precip_sum", "precip_sum_ly", "precip_ratio_ly"))

# every month from a station's first of the year on, with or without facts of its own
ORACLE["ytd_by_station_month"] = _with(DLY, CAL) + f""",
c AS (SELECT DISTINCT station_id, year, month FROM cal, (SELECT DISTINCT station_id FROM dly))
SELECT c.station_id, c.year, c.month, {rnd(mean('temp_avg_c'))} AS temp_ytd,
  {rnd(total('precip_total_mm'))} AS precip_ytd, {rnd(total('etp_total_mm'))} AS etp_ytd
FROM c JOIN dly ON c.station_id = dly.station_id AND year(date_local) = c.year AND month(date_local) <= c.month GROUP BY ALL"""

ORACLE["ytd_by_period_label"] = _with(DLY, CAL) + f""",
c AS (SELECT station_id, season, {total('precip_total_mm')} AS p FROM dly JOIN cal USING (date_local) GROUP BY ALL),
e AS (SELECT season, max(date_local) AS last FROM cal GROUP BY 1),
y AS (SELECT station_id, season, {total('precip_total_mm')} AS p FROM dly
      JOIN e ON year(date_local) = year(last) AND date_local <= last GROUP BY ALL)
SELECT station_id, season, {rnd('c.p')} AS precip_sum, {rnd('y.p')} AS precip_ytd FROM c FULL JOIN y USING (station_id, season)"""

ORACLE["ytd_by_year_day_of_month"] = _with(DLY, CAL) + f""",
e AS (SELECT year, day_of_month, max(date_local) AS last FROM cal GROUP BY ALL),
c AS (SELECT year, day_of_month, {total('precip_total_mm')} AS p FROM dly JOIN cal USING (date_local) GROUP BY ALL),
y AS (SELECT e.year, day_of_month, {mean('temp_avg_c')} AS t, {total('precip_total_mm')} AS p FROM dly
      JOIN e ON year(date_local) = e.year AND date_local <= last GROUP BY ALL)
SELECT year, day_of_month, {rnd('c.p')} AS precip_sum, {rnd('t')} AS temp_ytd, {rnd('y.p')} AS precip_ytd
FROM c FULL JOIN y USING (year, day_of_month)"""

ORACLE["ytd_after_last_reading"] = _with(DLY, CAL) + f""",
d AS (SELECT * FROM dly WHERE NOT (right(station_id, 1) IN ('1', '3', '5', '7', '9') AND month(date_local) > 4)),
c AS (SELECT DISTINCT station_id, year, month FROM cal, (SELECT DISTINCT station_id FROM d))
SELECT c.station_id, c.year, c.month, CAST(sum({dec('precip_total_mm')}) FILTER (WHERE month(date_local) = c.month) AS DOUBLE) AS precip_sum,
  {rnd(total('precip_total_mm'))} AS precip_ytd, {rnd(total('etp_total_mm'))} AS etp_ytd
FROM c JOIN d ON c.station_id = d.station_id AND year(date_local) = c.year AND month(date_local) <= c.month GROUP BY ALL"""

_PART = "CAST(sum({x}) FILTER (WHERE is_el_nino = {v}) AS DOUBLE)"
_NINO, _NORMAL = (_PART.format(x=dec("precip_total_mm"), v=v) for v in (1, 0))
ORACLE["enso_split"] = _with(DLY, CAL) + f"""
SELECT year, {rnd(total('precip_total_mm'))} AS precip_sum, {rnd(_NINO)} AS precip_nino, {rnd(_NORMAL)} AS precip_normal
FROM dly JOIN cal USING (date_local) GROUP BY year"""
ORACLE["enso_split_override"] = _with(DLY, CAL) + f""",
y AS (SELECT year, {_NINO} AS nino, {_NORMAL} AS normal FROM dly JOIN cal USING (date_local) GROUP BY year),
c AS (SELECT year, is_el_nino, {total('precip_total_mm')} AS p FROM dly JOIN cal USING (date_local) GROUP BY ALL)
SELECT c.year, c.is_el_nino, {rnd('p')} AS precip_sum, {rnd('nino')} AS precip_nino, {rnd('normal')} AS precip_normal
FROM c JOIN y ON c.year = y.year"""


ORACLE["enso_split_of_selection"] = _with(DLY, CAL) + f""",
y AS (SELECT DISTINCT year FROM cal WHERE is_el_nino = 1 AND quarter <= 3)
SELECT station_id, year, {rnd(_NINO)} AS precip_sum, {rnd(_NINO)} AS precip_nino, {rnd(_NORMAL)} AS precip_normal
FROM dly JOIN cal USING (date_local) JOIN y USING (year) WHERE quarter <= 3 GROUP BY station_id, year"""
ORACLE["deficit_of_selection"] = _with(DLY) + f"""
SELECT station_id, {integer('year(date_local)')} AS year, NULLIF(count(*) FILTER (WHERE water_balance_mm > 0), 0) AS n_days,
  CAST(sum({dec('precip_total_mm')}) FILTER (WHERE water_balance_mm > 0) AS DOUBLE) AS precip_sum,
  NULLIF(count(*) FILTER (WHERE water_balance_mm < -7), 0) AS deficit_days,
  {rnd('CAST(NULLIF(count(*) FILTER (WHERE water_balance_mm < -7), 0) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE water_balance_mm > 0), 0)')} AS deficit_days_share
FROM dly WHERE water_balance_mm > 0 OR water_balance_mm < -7 GROUP BY ALL"""


def _anomaly(keys: str, where: str = "true") -> str:
    return _with(DLY, CAL) + f""",
j AS (SELECT * FROM dly JOIN cal USING (date_local)),
h AS (SELECT station_id, {mean('temp_avg_c')} AS h FROM j WHERE is_el_nino = 0 GROUP BY 1),
c AS (SELECT {keys}, {mean('temp_avg_c')} AS t FROM j WHERE {where} GROUP BY {keys})
SELECT {', '.join('c.' + k.strip() for k in keys.split(','))}, {rnd('t')} AS temp_avg, {rnd(minus('t', 'h'))} AS temp_anomaly
FROM c LEFT JOIN h ON c.station_id = h.station_id"""


ORACLE["enso_anomaly"] = _anomaly("station_id, year")
ORACLE["enso_anomaly_of_selection"] = _anomaly("station_id", "enso_period = 'Episode A'")
ORACLE["periods_by_season"] = _with(DLY, CAL) + f"""
SELECT enso_period, season, {rnd(mean('temp_avg_c'))} AS temp_avg, {rnd(total('precip_total_mm'))} AS precip_sum, count(*) AS n_days
FROM dly JOIN cal USING (date_local) GROUP BY enso_period, season"""

_PER_DAY = f"({total('water_balance_mm')} / count(*))"
_DEFICIT = "NULLIF(count(*) FILTER (WHERE water_balance_mm < -7), 0)"
ORACLE["water_management"] = _with(DLY) + f"""
SELECT station_id, {integer('year(date_local)')} AS year, {integer('month(date_local)')} AS month,
  {rnd(total('etp_total_mm') + ' / count(*)')} AS etp_per_day, {rnd(total('precip_total_mm') + ' / count(*)')} AS precip_per_day,
  {_DEFICIT} AS deficit_days, {rnd(f'CAST({_DEFICIT} AS DOUBLE) / count(*)')} AS deficit_days_share,
  CASE WHEN {_PER_DAY} > 0 THEN '✅ Sin necesidad de riego' WHEN {_PER_DAY} > -3 THEN '🟡 Riego ligero recomendado'
       WHEN {_PER_DAY} > -6 THEN '🟠 Riego moderado necesario' ELSE '🔴 Riego intensivo crítico' END AS irrigation_advice
FROM dly GROUP BY ALL"""
ORACLE["negative_balance_months"] = _with(DLY, MONTHLY) + f"""
SELECT count(*) FILTER (WHERE water_balance_mm < 0) AS n_negative, count(*) AS n_months,
  {rnd('CAST(count(*) FILTER (WHERE water_balance_mm < 0) AS DOUBLE) / count(*)')} AS negative_share FROM monthly"""

ORACLE["station_rankings"] = _with(DLY, DIM) + f""",
v AS (SELECT d.station_id, any_value(d.station_name) AS station_name, {mean('temp_avg_c')} AS t, {total('etp_total_mm')} AS e
      FROM dim d LEFT JOIN dly f ON d.station_id = f.station_id GROUP BY d.station_id)
SELECT station_id, station_name, {rnd('t')} AS temp_avg, dense_rank() OVER (ORDER BY coalesce(t, 0) DESC) AS rank_temp,
  {rnd('e')} AS etp_sum, dense_rank() OVER (ORDER BY coalesce(e, 0) DESC) AS rank_etp FROM v"""
ORACLE["station_rankings_by_year"] = _with(DLY, DIM) + f""",
y AS (SELECT DISTINCT {integer('year(date_local)')} AS year FROM dly),
v AS (SELECT d.station_id, any_value(d.station_name) AS station_name, y.year, {total('etp_total_mm')} AS e
      FROM dim d CROSS JOIN y LEFT JOIN dly f ON d.station_id = f.station_id AND year(f.date_local) = y.year GROUP BY d.station_id, y.year)
SELECT station_id, station_name, year, {rnd('e')} AS etp_sum,
  dense_rank() OVER (PARTITION BY year ORDER BY coalesce(e, 0) DESC) AS rank_etp FROM v"""
ORACLE["hottest_stations"] = _with(DLY, DIM) + f""",
v AS (SELECT station_id, {integer('year(date_local)')} AS year, {integer('month(date_local)')} AS month, {mean('temp_avg_c')} AS t FROM dly GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY year, month ORDER BY t DESC NULLS LAST) AS rk FROM v)
SELECT year, month, string_agg(station_name, '' ORDER BY station_name) AS hottest_station
FROM r JOIN dim ON r.station_id = dim.station_id WHERE rk = 1 GROUP BY year, month"""


def _heatmap(cell: str, year: str = "") -> str:
    cells = ", ".join(f"max(v) FILTER (WHERE m = {m}) AS m{m:02d}" for m in range(1, 13))
    keys = "station_id, year" if year else "station_id"
    return _with(DLY) + f""", c AS (SELECT station_id, {year} month(date_local) AS m, {cell} AS v FROM dly GROUP BY ALL)
SELECT {keys}, {cells} FROM c GROUP BY {keys}"""


ORACLE["heatmap_temperature"] = _heatmap(rnd(mean("temp_avg_c"), 4))
ORACLE["heatmap_balance"] = _heatmap(rnd(total("water_balance_mm"), 4))
ORACLE["heatmap_rain_by_year"] = _heatmap(rnd(total("precip_total_mm"), 4), f"{integer('year(date_local)')} AS year,")
ORACLE["station_map"] = _with(DLY, DIM) + f"""
SELECT d.station_id, d.station_name, d.latitude, d.longitude, {rnd(mean('temp_avg_c'))} AS temp_avg, {rnd(total('precip_total_mm'))} AS precip_sum
FROM dim d JOIN dly f ON d.station_id = f.station_id GROUP BY d.station_id, d.station_name, d.latitude, d.longitude"""
ORACLE["daily_series"] = _with(DLY) + f"""
SELECT station_id, date_local, {rnd('temp_avg_c')} AS temp_avg, {rnd('precip_total_mm')} AS precip_sum FROM dly"""

ORACLE["monthly_series"] = _with(DLY) + f"""
SELECT station_id, {integer('year(date_local)')} AS year, {integer('month(date_local)')} AS month, {rnd(mean('temp_avg_c'))} AS temp_avg,
  {rnd(total('precip_total_mm'))} AS precip_sum, {rnd(total('etp_total_mm'))} AS etp_sum FROM dly GROUP BY ALL"""
ORACLE["stations_of_facts"] = "SELECT DISTINCT 'STN_' || CAST(l_suppkey AS VARCHAR) AS station_id FROM lineitem ORDER BY 1"
_TEN = OBS + """, ten AS (SELECT station_id, time_bucket(INTERVAL 10 MINUTE, event_ts) AS observation_ts FROM obs),
grid AS (SELECT station_id, observation_ts FROM (SELECT DISTINCT station_id FROM ten)
         CROSS JOIN (SELECT unnest(generate_series(lo, hi, INTERVAL 10 MINUTE)) AS observation_ts
                     FROM (SELECT min(observation_ts) AS lo, max(observation_ts) AS hi FROM ten)))"""
ORACLE["completeness_by_ten_minutes"] = _with(_TEN) + f""",
days AS (SELECT DISTINCT station_id, CAST(observation_ts AS DATE) AS date_local FROM grid),
s AS (SELECT station_id, CAST(observation_ts AS DATE) AS date_local, count(DISTINCT observation_ts) AS n FROM ten GROUP BY ALL)
SELECT station_id, date_local, coalesce(n, 0) AS n_observed, 144 AS n_expected, {rnd('coalesce(n, 0) / 144.0')} AS completeness
FROM days LEFT JOIN s USING (station_id, date_local)"""
ORACLE["missing_ten_minutes"] = _with(_TEN) + "SELECT station_id, observation_ts FROM grid EXCEPT SELECT station_id, observation_ts FROM ten"
ORACLE["completeness"] = _with(OBS) + f""",
s AS (SELECT station_id, CAST(observation_ts AS DATE) AS date_local, count(DISTINCT observation_ts) AS n FROM obs GROUP BY ALL),
g AS (SELECT station_id, date_local FROM (SELECT DISTINCT station_id FROM s)
      CROSS JOIN (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_local
                  FROM (SELECT min(date_local) AS lo, max(date_local) AS hi FROM s)))
SELECT g.station_id, g.date_local, coalesce(n, 0) AS n_observed, 48 AS n_expected, {rnd('coalesce(n, 0) / 48.0')} AS completeness
FROM g LEFT JOIN s ON g.station_id = s.station_id AND g.date_local = s.date_local"""
ORACLE["missing_slots"] = _with(OBS) + """,
g AS (SELECT station_id, observation_ts FROM (SELECT DISTINCT station_id FROM obs)
      CROSS JOIN (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS observation_ts
                  FROM (SELECT min(observation_ts) AS lo, max(observation_ts) AS hi FROM obs)))
SELECT station_id, observation_ts FROM g EXCEPT SELECT station_id, observation_ts FROM obs"""

# Forecast yardsticks ----------------------------------------------------------------------------

_SERIES = """series AS (
  SELECT station_id, 'temperatura_media' AS target, date_local AS ds, temp_avg_c AS y FROM dly WHERE temp_avg_c IS NOT NULL
  UNION ALL SELECT station_id, 'etp_diaria', date_local, etp_total_mm FROM dly WHERE etp_total_mm IS NOT NULL
)"""
_FUTURE = "CAST(unnest(generate_series(last + 1, last + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date"
ORACLE["forecast_trend"] = _with(DLY, _SERIES) + f""",
p AS (SELECT station_id, target, max(ds) AS last, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS sx, {total('y')} AS sy,
        CAST(sum(x * x) AS DOUBLE) AS sxx, CAST(sum(x * {dec('y')}) AS DOUBLE) AS sxy
      FROM (SELECT *, CAST(ds - DATE '1970-01-01' AS BIGINT) AS x FROM series) GROUP BY station_id, target),
l AS (SELECT station_id, target, sx / n AS mx, sy / n AS my, (n * sxy - sx * sy) / NULLIF(n * sxx - sx * sx, 0) AS slope, {_FUTURE} FROM p)
SELECT station_id, target, forecast_date, {rnd('slope')} AS slope,
  {rnd("my + slope * (CAST(forecast_date - DATE '1970-01-01' AS DOUBLE) - mx)", 4)} AS forecast_value FROM l"""
_BAND = _SERIES + f""", p AS (
  SELECT station_id, target, max(ds) AS last, count(*) AS n, CAST(sum(x) AS HUGEINT) AS sx, CAST(sum(y) AS HUGEINT) AS sy,
    CAST(sum(x * x) AS HUGEINT) AS sxx, CAST(sum(x * y) AS HUGEINT) AS sxy, CAST(sum(y * y) AS HUGEINT) AS syy
  FROM (SELECT station_id, target, ds, CAST(ds - DATE '1970-01-01' AS BIGINT) AS x, CAST(round(y * 10000) AS BIGINT) AS y FROM series)
  GROUP BY station_id, target),
l AS (SELECT station_id, target, last, CAST(n AS DOUBLE) AS n, CAST(sx AS DOUBLE) / n AS mx, CAST(sy AS DOUBLE) / n AS my,
    CAST(n * sxx - sx * sx AS DOUBLE) AS dxx, CAST(n * sxy - sx * sy AS DOUBLE) AS dxy, CAST(n * syy - sy * sy AS DOUBLE) AS dyy FROM p),
f AS (SELECT *, dxy / dxx AS slope, CASE WHEN n > 2 THEN greatest(0.0, (dyy - dxy * (dxy / dxx)) / n) / (n - 2) END AS noise, {_FUTURE}
      FROM l WHERE dxx > 0),
v AS (SELECT station_id, target, forecast_date, my + slope * ahead AS value,
        1.2815515655446004::DOUBLE * sqrt(noise * (1.0::DOUBLE + 1.0::DOUBLE / n + ahead * ahead * n / dxx)) AS half
      FROM (SELECT *, CAST(forecast_date - DATE '1970-01-01' AS DOUBLE) - mx AS ahead FROM f)),
band AS (SELECT station_id, forecast_date, target, {rnd('value / 10000', 4)} AS forecast_value,
  {rnd('(value - half) / 10000', 4)} AS forecast_lower_80, {rnd('(value + half) / 10000', 4)} AS forecast_upper_80,
  'linear trend' AS model_name FROM v)"""
ORACLE["forecast_trend_band"] = _with(DLY, _BAND) + "SELECT * FROM band"
ORACLE["forecast_trend_summary"] = _with(DLY, _BAND) + f"""
SELECT station_id, target, count(*) AS n_days, {rnd(mean('forecast_value'), 2)} AS avg_forecast, {rnd('min(forecast_value)', 2)} AS min_forecast,
  {rnd('max(forecast_value)', 2)} AS max_forecast, {rnd('min(forecast_lower_80)', 2)} AS min_lower, {rnd('max(forecast_upper_80)', 2)} AS max_upper
FROM band GROUP BY station_id, target"""


def _of(target: str, column: str) -> str:
    return f"CASE WHEN target = '{target}' THEN {column} END"


ORACLE["forecast_trend_kpis"] = _with(DLY, _BAND) + f"""
SELECT station_id, {rnd(mean(_of('temperatura_media', 'forecast_value')))} AS forecast_temp,
  {rnd(total(_of('etp_diaria', 'forecast_value')))} AS forecast_etp,
  {rnd(mean(_of('temperatura_media', 'forecast_lower_80')))} AS forecast_temp_lower,
  {rnd(mean(_of('temperatura_media', 'forecast_upper_80')))} AS forecast_temp_upper FROM band GROUP BY station_id"""
ORACLE["history_and_trend"] = _with(DLY, _BAND) + """
SELECT s.station_id, s.target, ds AS day, y AS value, CAST(NULL AS DOUBLE) AS lower_80, CAST(NULL AS DOUBLE) AS upper_80, 'history' AS part
FROM series s JOIN (SELECT station_id, target, max(ds) AS last FROM series GROUP BY 1, 2) e
  ON s.station_id = e.station_id AND s.target = e.target WHERE ds > last - 90
UNION ALL SELECT station_id, target, forecast_date, forecast_value, forecast_lower_80, forecast_upper_80, 'forecast' FROM band"""
ORACLE["forecast_seasonal_naive"] = _with(DLY, _SERIES) + f""",
f AS (SELECT station_id, target, {_FUTURE} FROM (SELECT station_id, target, max(ds) AS last FROM series GROUP BY 1, 2))
SELECT f.station_id, f.target, f.forecast_date, {rnd(mean('s.y'), 4)} AS forecast_value, count(s.y) AS n_years
FROM f LEFT JOIN series s ON f.station_id = s.station_id AND f.target = s.target
  AND month(s.ds) = month(f.forecast_date) AND day(s.ds) = day(f.forecast_date)
GROUP BY f.station_id, f.target, f.forecast_date"""
