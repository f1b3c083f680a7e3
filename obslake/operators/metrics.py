"""The metric layer: named measures evaluated in any combination of contexts.

Every measure is an expression over mergeable base states (sums, counts, extremes).  ``evaluate`` asks
for the states its measures need, gets them from one aggregate over the daily fact, and computes the
measures on the few rows that come out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from obslake.functions.exact import amount, mean, ratio, ticks
from obslake.operators import timeintel as ti
from obslake.operators.numbering import dense_rank_desc, top_with_ties
from obslake.schema import FORECAST_TARGETS, SEVERE_DEFICIT_MM
from obslake.session import cut_lineage, literal_rows

Make = Callable[["Context"], Column]


@dataclass(frozen=True)
class MetricSpec:
    """A measure: column name, display name, folder, display format, text, and its expression."""

    key: str
    name: str
    folder: str
    format: str
    description: str
    needs: tuple[str, ...]
    make: Make
    table: str = "fact_daily_summary"


@dataclass(frozen=True)
class Context:
    """What a measure sees: the states of its row, and whether a missing value counts as 0 in differences
    and comparisons (as it does in the report model)."""

    blank_as_zero: bool = True

    def count(self, state: str) -> Column:
        return F.col(state)

    def value(self, state: str) -> Column:
        return F.col(state).cast("double")

    def total(self, state: str) -> Column:
        return amount(F.col(state))

    def mean(self, total: str, count: str) -> Column:
        return mean(F.col(total), F.col(count))

    def days(self, state: str = "cur_n") -> Column:
        return F.nullif(F.col(state), F.lit(0))

    def minus(self, a: Column, b: Column) -> Column:
        """Difference in which one missing side counts as 0, and two missing sides stay missing."""
        if not self.blank_as_zero:
            return a - b
        return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0)))


def _base_states() -> dict[str, Callable[[Column | None], Column]]:
    """State name to an aggregate restricted to the rows where the flag holds."""

    def keep(c: Column, flag: Column | None) -> Column:
        return c if flag is None else F.when(flag, c)

    def total(c: str):
        return lambda flag: F.sum(keep(ticks(c), flag))

    def whole(c: str):
        return lambda flag: F.sum(keep(F.col(c), flag))

    def filled(c: str):
        return lambda flag: F.count(keep(ticks(c), flag))  # what is added up, and nothing else

    one = F.lit(1)
    return {
        "t_sum": total("temp_avg_c"), "t_n": filled("temp_avg_c"),
        "t_max": lambda f: F.max(keep(F.col("temp_max_c"), f)), "t_min": lambda f: F.min(keep(F.col("temp_min_c"), f)),
        "h_sum": total("humidity_avg_pct"), "h_n": filled("humidity_avg_pct"),
        "p_sum": total("precip_total_mm"), "e_sum": total("etp_total_mm"), "b_sum": total("water_balance_mm"),
        "n": lambda f: F.count(keep(one, f)),
        "hot": whole("is_hot_day"), "rainy": whole("is_rainy_day"),
        "windy": whole("is_windy_day"), "uv": whole("is_uv_extreme"),
        "deficit": lambda f: F.count(keep(F.when(F.col("water_balance_mm") < SEVERE_DEFICIT_MM, one), f)),
    }


CATALOGUE: dict[str, MetricSpec] = {}


def define(
    key: str, name: str, folder: str, fmt: str, description: str, needs: Sequence[str], make: Make, **kw,
) -> MetricSpec:
    """Create a measure, or replace the one of the same name."""
    for old in [k for k, spec in CATALOGUE.items() if spec.name == name]:
        del CATALOGUE[old]
    CATALOGUE[key] = MetricSpec(key, name, folder, fmt, description, tuple(needs), make, **kw)
    return CATALOGUE[key]


def _temp(role: str) -> tuple[tuple[str, str], Make]:
    states = (f"{role}_t_sum", f"{role}_t_n")
    return states, lambda c: c.mean(*states)


# Display names, folders and display formats of the measures.
_CORE, _EXTREME, _TIME, _ENSO, _WATER, _FORECAST, _RANK = (
    "01 KPIs Core", "02 Eventos Extremos", "03 Time Intelligence", "04 Análisis Niño", "05 Gestión Hídrica",
    "06 Forecasting", "07 Rankings")
_CELSIUS, _MM, _COUNT, _SHARE = '0.0 "°C"', '#,0.0 "mm"', "#,0", "0.0 %"
_DELTA, _DELTA_SHARE, _MM_DAY = '+0.0 "°C";-0.0 "°C";0', "+0.0 %;-0.0 %;0", '0.00 "mm/día"'

define("temp_avg", "Temp Promedio", _CORE, _CELSIUS, "Mean of the daily mean temperatures", *_temp("cur"))
define("temp_max", "Temp Máxima", _CORE, _CELSIUS, "Highest daily maximum", ["cur_t_max"], lambda c: c.value("cur_t_max"))
define("temp_min", "Temp Mínima", _CORE, _CELSIUS, "Lowest daily minimum", ["cur_t_min"], lambda c: c.value("cur_t_min"))
define("humidity_avg", "Humedad Promedio", _CORE, '0.0 "%"', "Mean of the daily mean humidities",
       ["cur_h_sum", "cur_h_n"], lambda c: c.mean("cur_h_sum", "cur_h_n"))
define("precip_sum", "Precipitación Acumulada", _CORE, _MM, "Rain, added over days and stations",
       ["cur_p_sum"], lambda c: c.total("cur_p_sum"))
define("etp_sum", "ETP Acumulada", _CORE, _MM, "Reference evapotranspiration, added over days and stations",
       ["cur_e_sum"], lambda c: c.total("cur_e_sum"))
define("balance_sum", "Balance Hídrico", _CORE, _MM, "Rain less evapotranspiration; negative is a deficit",
       ["cur_b_sum"], lambda c: c.total("cur_b_sum"))
define("n_days", "Días con Datos", _CORE, _COUNT, "Station-days with data", ["cur_n"], lambda c: c.days())

for _key, _state, _name, _text in [
    ("hot_days", "hot", "Días con Calor Extremo", "Days flagged as hot"),
    ("rainy_days", "rainy", "Días Lluviosos", "Days flagged as rainy"),
    ("windy_days", "windy", "Días con Vientos Fuertes", "Days flagged as windy"),
    ("uv_days", "uv", "Días con UV Crítico", "Days flagged for extreme UV"),
]:
    define(_key, _name, _EXTREME, _COUNT, _text, [f"cur_{_state}"], lambda c, s=f"cur_{_state}": c.count(s))
define("hot_days_share", "% Días con Calor Extremo", _EXTREME, _SHARE, "Hot days per day with data",
       ["cur_hot", "cur_n"], lambda c: ratio(c.count("cur_hot"), c.days()))

define("temp_avg_ly", "Temp Promedio AA", _TIME, _CELSIUS, "Mean temperature, same days last year", *_temp("ly"))
define("temp_delta_ly", "Δ Temp vs AA", _TIME, _DELTA, "Mean temperature less that of last year",
       ["cur_t_sum", "cur_t_n", "ly_t_sum", "ly_t_n"],
       lambda c: c.minus(c.mean("cur_t_sum", "cur_t_n"), c.mean("ly_t_sum", "ly_t_n")))
define("temp_delta_ly_share", "Δ Temp vs AA %", _TIME, _DELTA_SHARE, "That difference relative to last year",
       ["cur_t_sum", "cur_t_n", "ly_t_sum", "ly_t_n"],
       lambda c: F.try_divide(c.minus(c.mean("cur_t_sum", "cur_t_n"), c.mean("ly_t_sum", "ly_t_n")),
                              c.mean("ly_t_sum", "ly_t_n")))
define("precip_sum_ly", "Precip Acum AA", _TIME, _MM, "Rain, same days last year",
       ["ly_p_sum"], lambda c: c.total("ly_p_sum"))
define("precip_ratio_ly", "Multiplicador Lluvia vs AA", _TIME, '0.0 "x"', "Rain as a multiple of last year's",
       ["cur_p_sum", "ly_p_sum"], lambda c: ratio(c.total("cur_p_sum"), c.total("ly_p_sum")))
define("temp_ytd", "Temp YTD", _TIME, _CELSIUS, "Mean temperature since 1 January (mean of days)", *_temp("ytd"))
define("precip_ytd", "Precip YTD", _TIME, _MM, "Rain since 1 January", ["ytd_p_sum"], lambda c: c.total("ytd_p_sum"))
define("etp_ytd", "ETP YTD", _TIME, _MM, "Evapotranspiration since 1 January",
       ["ytd_e_sum"], lambda c: c.total("ytd_e_sum"))

define("precip_nino", "Lluvia en Período Niño", _ENSO, _MM, "Rain on El Niño days",
       ["nino_p_sum"], lambda c: c.total("nino_p_sum"))
define("precip_normal", "Lluvia en Período Normal", _ENSO, _MM, "Rain on days without El Niño",
       ["normal_p_sum"], lambda c: c.total("normal_p_sum"))
define("temp_anomaly", "Anomalía Temp vs Promedio Histórico", _ENSO, _DELTA,
       "Mean temperature less the mean of all days without El Niño",
       ["cur_t_sum", "cur_t_n", "hist_t_sum", "hist_t_n"],
       lambda c: c.minus(c.mean("cur_t_sum", "cur_t_n"), c.mean("hist_t_sum", "hist_t_n")))

define("etp_per_day", "ETP Diaria Promedio", _WATER, _MM_DAY, "Evapotranspiration per day with data",
       ["cur_e_sum", "cur_n"], lambda c: ratio(c.total("cur_e_sum"), c.days()))
define("precip_per_day", "Lluvia Diaria Promedio", _WATER, _MM_DAY, "Rain per day with data",
       ["cur_p_sum", "cur_n"], lambda c: ratio(c.total("cur_p_sum"), c.days()))
define("deficit_days", "Días con Déficit Hídrico Severo", _WATER, _COUNT, "Days in severe water deficit",
       ["cur_deficit"], lambda c: c.days("cur_deficit"))
define("deficit_days_share", "% Días con Déficit Severo", _WATER, _SHARE, "Those days per day with data",
       ["cur_deficit", "cur_n"], lambda c: ratio(c.days("cur_deficit"), c.days()))

# Advice by balance per day (mm), strictly above each bound, and below all of them.
IRRIGATION_ADVICE = [
    (0, "✅ Sin necesidad de riego"),
    (-3, "🟡 Riego ligero recomendado"),
    (-6, "🟠 Riego moderado necesario"),
]
IRRIGATION_CRITICAL = "🔴 Riego intensivo crítico"


def _advice(c: Context) -> Column:
    per_day = ratio(c.total("cur_b_sum"), c.days())
    shown = F.coalesce(per_day, F.lit(0.0)) if c.blank_as_zero else per_day
    text = F.lit(IRRIGATION_CRITICAL)
    for bound, advice in reversed(IRRIGATION_ADVICE):
        text = F.when(shown > bound, F.lit(advice)).otherwise(text)
    return text if c.blank_as_zero else F.when(per_day.isNotNull(), text)


define("irrigation_advice", "Recomendación de Riego", _WATER, "", "Advice by the mean daily balance",
       ["cur_b_sum", "cur_n"], _advice)

_FC = {"table": "fact_forecast"}
define("forecast_temp", "Forecast Temp", _FORECAST, _CELSIUS, "Mean of the forecast temperatures",
       ["fc_t_sum", "fc_t_n"], lambda c: c.mean("fc_t_sum", "fc_t_n"), **_FC)
define("forecast_etp", "Forecast ETP", _FORECAST, _MM, "Forecast evapotranspiration over the horizon",
       ["fc_e_sum"], lambda c: c.total("fc_e_sum"), **_FC)
define("forecast_temp_lower", "Forecast Temp Lower", _FORECAST, _CELSIUS, "Lower end of the 80 % band",
       ["fc_lo_sum", "fc_lo_n"], lambda c: c.mean("fc_lo_sum", "fc_lo_n"), **_FC)
define("forecast_temp_upper", "Forecast Temp Upper", _FORECAST, _CELSIUS, "Upper end of the 80 % band",
       ["fc_hi_sum", "fc_hi_n"], lambda c: c.mean("fc_hi_sum", "fc_hi_n"), **_FC)

# Ranks look across stations, so ``rank_stations`` and ``hottest_station`` compute them.
define("rank_temp", "Ranking Temp", _RANK, "0", "Dense rank of the station by mean temperature", [], None)
define("rank_etp", "Ranking ETP", _RANK, "0", "Dense rank of the station by evapotranspiration", [], None)
define("hottest_station", "Estación con Más Calor", _RANK, "", "Station(s) with the highest mean temperature", [], None)

Selection = ti.FilterContext | Mapping[str, Column | Sequence] | Column | None

ROLES = ("cur", "ly", "nino", "normal")
_DAYS, _PARTS_OF_YEAR = {"date_local", "date_id"}, {"year", "quarter", "month", "month_name"}
#: The column of the daily fact that a state puts its own condition on.
_OWN_COLUMN = {"deficit": "water_balance_mm"}


def _follow_each_other(date_keys: Sequence[str]) -> bool:
    """Whether these contexts cut a year into stretches one after the other: days, or the year and parts of it."""
    keys = set(date_keys)
    return bool(keys & _DAYS) or ("year" in keys and keys <= _PARTS_OF_YEAR)


def evaluate(
    daily: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), calendar: DataFrame | None = None,
    dates: Selection = None, entities: Selection = None, blank_as_zero: bool = True,
    formatted: bool = False,
) -> DataFrame:
    """Measures per combination of ``by``, one row each.

    Columns of ``by`` that the calendar has are its date contexts; the others are columns of ``daily``.
    ``dates`` selects days of the calendar, ``entities`` rows of ``daily``.  Measures of last year, of
    the year to date and of El Niño move along the calendar and keep the selection of entities.

    A selection is a condition, or a mapping of columns to allowed values or conditions (a ``FilterContext``).
    Measures that put a condition on a column themselves (El Niño and normal rain, days in severe deficit) replace the mapping's entry
    of that column; a plain condition is opaque, so they add to it.  Combinations are those the selected days have.  A row
    exists where the facts of the context itself, of last year or of the year to date do.
    """
    specs = [CATALOGUE[m] for m in metrics]
    bad = [s.key for s in specs if s.make is None or s.table != "fact_daily_summary"]
    if bad:
        raise ValueError(f"not measures of the daily fact: {bad}")
    needed = list(dict.fromkeys(n for s in specs for n in s.needs))
    date_keys = [k for k in by if calendar is not None and k in calendar.columns]
    entity = [k for k in by if k not in date_keys]
    states = _states(daily, needed, entity, date_keys, calendar, ti.FilterContext.of(dates), ti.FilterContext.of(entities))
    context = Context(blank_as_zero)
    out = states.select(*by, *[s.make(context).alias(s.key) for s in specs])
    return with_display(out, specs) if formatted else out


def _states(daily, needed, entity, date_keys, calendar, dates, entities) -> DataFrame:
    def of(role: str) -> list[str]:
        return [n[len(role) + 1:] for n in needed if n.startswith(f"{role}_")]

    # A state with a condition of its own on a column reads the rows with the selection on that column cleared.
    cleared = {c for c in _OWN_COLUMN.values() if c in entities.entries and any(n.endswith(f"_{s}") for n in needed for s in _OWN_COLUMN)}
    kept, narrow = entities, {c: entities.only(c) for c in cleared}
    for c in cleared:
        kept = kept.without(c)
    facts = kept.apply(daily)
    if narrow:  # rows that no state reads would make rows without any value
        own = F.col("water_balance_mm") < SEVERE_DEFICIT_MM
        facts = facts.filter(own | reduce(lambda a, b: a & b, narrow.values()))

    def state(name: str, flag: Column | None = None) -> Column:
        for c, condition in narrow.items():
            if _OWN_COLUMN.get(name) != c:
                flag = condition if flag is None else flag & condition
        return _base_states()[name](flag)

    keys = [ti.context_key(k) for k in date_keys]
    if calendar is None:
        if any(of(r) for r in (*ROLES[1:], "ytd", "hist")):
            raise ValueError("measures that move along the calendar need one")
        return facts.groupBy(*entity).agg(*[state(s).alias(f"cur_{s}") for s in of("cur")])

    known = ti.with_context_keys(calendar, date_keys)
    selected = dates.apply(known)
    whole = dates.condition() is None
    aligned = whole and _follow_each_other(date_keys)
    hist_in_contexts = bool(of("hist")) and whole and bool(entity)

    def nino(value: int) -> DataFrame:
        return ti.override_days(selected, dates.without("is_el_nino").apply(known), keys, "is_el_nino", value)

    days = {"cur": lambda: ti.current_days(selected, keys),
            "ly": lambda: ti.days_last_year(selected, known, keys),
            "nino": lambda: nino(1), "normal": lambda: nino(0),
            "hist": lambda: ti.current_days(selected.filter(F.col("is_el_nino") == 0), keys)}
    wanted = {r: of(r) for r in ROLES if of(r)}
    if of("ytd") and (aligned or not wanted):
        wanted["cur"] = list(dict.fromkeys(wanted.get("cur", []) + (of("ytd") if aligned else ["n"])))
    if hist_in_contexts:
        wanted["hist"] = of("hist")
    roles = {r: days[r]() for r in wanted}
    table = ti.bridge(roles, keys)
    flags = {r: (None if list(wanted) == [r] else F.col(f"in_{r}")) for r in wanted}
    out = facts.join(F.broadcast(table), ti.DAY).groupBy(*entity, *keys).agg(*[
        state(s, flags[r]).alias(f"{r}_{s}") for r in wanted for s in wanted[r]])

    if of("ytd"):
        out = _add_year_to_date(out, facts, known, selected, entity, keys, of("ytd"), aligned, state)
    if of("hist"):
        out = _add_history(out, facts, known, entity, of("hist"), hist_in_contexts, state)
    return out.withColumnsRenamed(dict(zip(keys, date_keys)))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _add_year_to_date(out, facts, known, selected, entity, keys, states, aligned, state) -> DataFrame:
    lasts = ti.last_days(selected, keys)
    if aligned:  # the contexts' own totals add up; the facts are not read again
        return ti.running_within_year(out, lasts, entity, keys, {f"ytd_{s}": f"cur_{s}" for s in states})
    running = ti.year_to_date(facts, known, lasts, entity, keys, {f"ytd_{s}": state(s) for s in states})
    # one row per entity and context on either side, whichever of them exist; keys may be missing values
    columns = [c for c in out.columns if c not in (*entity, *keys)]
    both = out.unionByName(running, allowMissingColumns=True)
    return both.groupBy(*entity, *keys).agg(*[F.max(c).alias(c) for c in (*columns, *(f"ytd_{s}" for s in states))])


def _add_history(out, facts, known, entity, states, in_contexts, state) -> DataFrame:
    if in_contexts:
        # The contexts cover every day once, so their normal days add up to the whole history.
        whole = Window.partitionBy(*entity)
        return out.withColumns({f"hist_{s}": F.sum(f"hist_{s}").over(whole) for s in states})
    normal = known.filter(F.col("is_el_nino") == 0).select(ti.DAY).distinct()
    history = facts.join(F.broadcast(normal), ti.DAY, "left_semi").groupBy(*entity).agg(
        *[state(s).alias(f"hist_{s}") for s in states])
    if entity:
        return _null_safe(out, history, entity, "left")
    return out.withColumns({f"hist_{s}": history.select(f"hist_{s}").scalar() for s in states})


def evaluate_forecast(forecast: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Measures of the forecast fact per combination of ``by``."""
    temp, etp = FORECAST_TARGETS["temp_avg_c"], FORECAST_TARGETS["etp_total_mm"]

    def of(target: str, c: str) -> Column:
        return F.when(F.col("target") == target, F.col(c))

    sources = {"fc_t": of(temp, "forecast_value"), "fc_e": of(etp, "forecast_value"),
               "fc_lo": of(temp, "forecast_lower_80"), "fc_hi": of(temp, "forecast_upper_80")}
    specs = [CATALOGUE[m] for m in metrics]
    states = [e for k, c in sources.items() for e in (F.sum(ticks(c)).alias(f"{k}_sum"), F.count(c).alias(f"{k}_n"))]
    grouped = forecast.groupBy(*by).agg(*states)
    return grouped.select(*by, *[s.make(Context()).alias(s.key) for s in specs])


def _station_contexts(daily, stations, metrics, date_keys, calendar, names) -> DataFrame:
    """The measures for every station in every date context; stations without data have NULL."""
    values = evaluate(daily, list(metrics), ["station_id", *date_keys], calendar)
    places = stations.select("station_id", *names)
    if not date_keys:
        return places.join(values, "station_id", "left")
    # A context table has at most a row per calendar day, so each station can carry it.
    contexts = values.agg(F.collect_set(F.struct(*date_keys))).scalar()
    grid = places.withColumn("_c", F.explode(contexts)).select(
        "station_id", *names, *[F.col(f"_c.{k}").alias(k) for k in date_keys])
    return grid.join(values, ["station_id", *date_keys], "left")


def rank_stations(
    daily: DataFrame, stations: DataFrame, ranks: Mapping[str, str], date_keys: Sequence[str] = (),
    calendar: DataFrame | None = None, names: Sequence[str] = ("station_name",),
) -> DataFrame:
    """Dense rank of every station by each measure (``{measure: rank column}``), highest first.

    All stations are ranked within a date context; one without data ranks as 0.  The measures are
    computed once and kept, since ranking reads them again.
    """
    ranked = cut_lineage(_station_contexts(daily, stations, ranks, date_keys, calendar, names))
    ranked = ranked.withColumns({f"_v_{m}": F.coalesce(m, F.lit(0.0)) for m in ranks})
    for metric, rank in ranks.items():
        ranked = dense_rank_desc(ranked, date_keys, f"_v_{metric}", rank)
    return ranked.select("station_id", *names, *date_keys, *[c for pair in ranks.items() for c in pair])


def hottest_station(
    daily: DataFrame, stations: DataFrame, date_keys: Sequence[str] = (), calendar: DataFrame | None = None,
) -> DataFrame:
    """Name of the station with the highest mean temperature per date context; ties are concatenated.

    Only stations of the dimension compete, so a context whose warmest facts are of no known station has a winner too.
    """
    values = evaluate(daily, ["temp_avg"], ["station_id", *date_keys], calendar)
    known = values.join(stations.select("station_id", "station_name"), "station_id")
    best = top_with_ties(known, date_keys, "temp_avg")
    ties = F.array_join(F.sort_array(F.collect_list("station_name")), "")
    return best.groupBy(*date_keys).agg(ties.alias("hottest_station"))


_SECTION = re.compile(r'^(?P<sign>[+-]?)(?P<group>#,)?0(?P<decimals>\.0+)?(?P<percent> ?%)?(?: ?"(?P<unit>[^"]*)")?$')


def display(value: Column, fmt: str) -> Column:
    """Text of a value in a display format of up to three sections (positive; negative; zero)."""
    if not fmt:
        return value.cast("string")

    def section(text: str, v: Column) -> Column:
        m = _SECTION.match(text)
        if m is None:
            raise ValueError(f"unsupported display format {text!r}")
        places = len(m["decimals"] or ".") - 1
        pattern = f"{m['sign']}%{',' if m['group'] else ''}.{places}f"
        tail = (" %%" if m["percent"] else "") + (f" {m['unit']}".replace("%", "%%") if m["unit"] else "")
        return F.format_string(pattern + tail, (v * 100 if m["percent"] else v).cast("double"))

    parts = fmt.split(";")
    if len(parts) == 1:
        return F.when(value.isNotNull(), section(parts[0], value))
    return (
        F.when(value > 0, section(parts[0], value)).when(value < 0, section(parts[1], F.abs(value)))
        .when(value == 0, section(parts[2], value))
    )


def with_display(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Add ``<measure>_text`` in the measure's display format."""
    return df.withColumns({f"{s.key}_text": display(F.col(s.key), s.format) for s in specs})


def metrics_catalog(spark: SparkSession) -> DataFrame:
    """The measures with their display names, formats, folders and texts."""
    rows = [(s.table, s.key, s.name, s.folder, s.format, s.description) for s in CATALOGUE.values()]
    fields = ["table", "key", "name", "folder", "format", "description"]
    return literal_rows(spark, rows, T.StructType([T.StructField(f, T.StringType()) for f in fields]))
