"""Daily forecasts, one model per station and target, fitted side by side.

The model follows the published additive form (Taylor and Letham, "Forecasting at scale", 2017): a
piecewise-linear trend whose slope changes are kept sparse, plus a yearly Fourier series.  Spark
shuffles the series; a task holds one series at a time, which has at most one row per calendar day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from obslake.functions.clock import days_between
from obslake.functions.exact import SCALE, dround, mean, round_mean, ticks
from obslake.schema import FORECAST_HORIZON, FORECAST_TARGETS

MODEL_NAME = "additive trend + yearly seasonality"
Z80 = 1.2815515655446004  # normal quantile of an 80 % band
SERIES = ["station_id", "target"]

FIT_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("forecast_date", T.DateType()), T.StructField("forecast_value", T.DoubleType()),
    T.StructField("forecast_lower_80", T.DoubleType()), T.StructField("forecast_upper_80", T.DoubleType()),
    T.StructField("error", T.StringType()),
])
_FIT_ARROW = pa.schema([
    ("station_id", pa.string()), ("target", pa.string()), ("forecast_date", pa.date32()), ("forecast_value", pa.float64()),
    ("forecast_lower_80", pa.float64()), ("forecast_upper_80", pa.float64()), ("error", pa.string()),
])


def history(daily: DataFrame, targets: Mapping[str, str] = FORECAST_TARGETS) -> DataFrame:
    """The daily fact as long series: station, target, day, value; missing values left out."""
    long = daily.select("station_id", F.col("date_local").alias("ds"), *targets).unpivot(
        ["station_id", "ds"], list(targets), "_column", "y")
    name = F.lit(None).cast("string")
    for column, target in targets.items():
        name = F.when(F.col("_column") == column, F.lit(target)).otherwise(name)
    return long.filter(F.col("y").isNotNull() & ~F.isnan("y")).select("station_id", name.alias("target"), "ds", "y")


class AdditiveModel:
    """Trend with sparse slope changes plus yearly seasonality, by reweighted ridge regression."""

    def __init__(self, changepoint_scale: float = 0.05, changepoints: int = 25, range_share: float = 0.8,
                 order: int = 10, period: float = 365.25, iterations: int = 25):
        self.changepoint_scale, self.changepoints, self.range_share = changepoint_scale, changepoints, range_share
        self.order, self.period, self.iterations = order, period, iterations

    def _design(self, day: np.ndarray) -> np.ndarray:
        t = (day - self.first) / self.span
        hinges = np.maximum(0.0, t[:, None] - self.knots[None, :])
        angle = 2.0 * np.pi * day[:, None] * np.arange(1, self.order + 1)[None, :] / self.period
        return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, np.sin(angle), np.cos(angle)])

    def fit(self, day: np.ndarray, y: np.ndarray) -> "AdditiveModel":
        if len(y) < 2:
            raise ValueError("a series needs at least two values")
        self.first, self.span = day[0], max(day[-1] - day[0], 1.0)
        self.scale = float(np.max(np.abs(y))) or 1.0
        early = int(np.floor(len(y) * self.range_share))
        count = max(0, min(self.changepoints, early - 1))
        places = np.linspace(0, early - 1, count + 1).round().astype(int)[1:] if count else np.array([], dtype=int)
        self.knots = (day[places] - self.first) / self.span
        x, target = self._design(day), y / self.scale
        gram, moment = x.T @ x, x.T @ target
        # Gaussian priors on level, slope (sd 5) and seasonality (sd 10); Laplace on the slope changes.
        penalty = np.concatenate([[1 / 25, 1 / 25], np.zeros(count), np.full(2 * self.order, 1 / 100)])
        hinge = slice(2, 2 + count)
        noise, change, power = float(np.var(target)) + 1e-6, np.full(count, 0.1), float(target @ target)
        for _ in range(self.iterations):
            penalty[hinge] = 1.0 / (self.changepoint_scale * (np.abs(change) + 1e-4))
            theta = np.linalg.solve(gram + np.diag(noise * penalty + 1e-10), moment)
            residual = power - 2.0 * (theta @ moment) + theta @ gram @ theta
            settled = noise
            change, noise = theta[hinge], max(float(residual), 0.0) / len(target) + 1e-9
            if abs(noise - settled) <= 1e-6 * noise:
                break
        self.theta, self.noise, self.change = theta, noise, change
        return self

    def predict(self, day: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Value, lower and upper end of the 80 % band."""
        value = self._design(day) @ self.theta
        ahead = np.maximum(0.0, (day - self.first) / self.span - 1.0)
        # Future slope changes: as frequent as in the history, Laplace with the mean size seen there.
        size = float(np.mean(np.abs(self.change))) if len(self.change) else 0.0
        trend_variance = len(self.change) * 2.0 * size ** 2 * ahead ** 3 / 3.0
        half = Z80 * np.sqrt(self.noise + trend_variance)
        return value * self.scale, (value - half) * self.scale, (value + half) * self.scale


def _fit_series(rows: pa.Table, horizon: int, options: dict) -> pa.Table:
    def answer(days, value, lower, upper, error) -> pa.Table:
        n = len(days)
        columns = [[rows["station_id"][0].as_py()] * n, [rows["target"][0].as_py()] * n, days, value, lower, upper, [error] * n]
        return pa.table({f.name: pa.array(c, type=f.type) for f, c in zip(_FIT_ARROW, columns, strict=True)})

    try:
        day, y = rows["ds"].cast(pa.int32()).to_numpy(), rows["y"].to_numpy()
        order = np.argsort(day)
        day, y = day[order].astype(float), y[order]
        if not np.isfinite(y).all():
            raise ValueError("the series holds a value that is not finite")
        future = day[-1] + np.arange(1, horizon + 1)
        value, lower, upper = AdditiveModel(**options).fit(day, y).predict(future)
        if not all(np.isfinite(x).all() for x in (value, lower, upper)):
            raise ValueError("the fit gave a value that is not finite")
        return answer(future.astype("int32"), value, lower, upper, None)
    except Exception as problem:  # one bad series must not stop the others
        return answer([None], [None], [None], [None], f"{type(problem).__name__}: {problem}")


def fit_all(series: DataFrame, horizon: int = FORECAST_HORIZON, **options) -> DataFrame:
    """Fit and predict every series; a series that fails gives one row with ``error`` set."""
    return series.groupBy(*SERIES).applyInArrow(lambda rows: _fit_series(rows, horizon, options), FIT_SCHEMA)


def split_failures(
    fitted: DataFrame, model_name: str = MODEL_NAME, run_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The forecast fact (8 columns), and the series that could not be fitted with the reason."""
    good = fitted.filter(F.col("error").isNull()).select(
        "station_id", "forecast_date", "target", "forecast_value", "forecast_lower_80", "forecast_upper_80",
        F.lit(model_name).alias("model_name"),
        (F.current_timestamp() if run_at is None else run_at).alias("model_run_ts"))
    return good, fitted.filter(F.col("error").isNotNull()).select(*SERIES, "error")


def fact_forecast(daily: DataFrame, horizon: int = FORECAST_HORIZON, targets=FORECAST_TARGETS, **options) -> DataFrame:
    return split_failures(fit_all(history(daily, targets), horizon, **options))[0]


def summary(forecast: DataFrame) -> DataFrame:
    """Days, mean value, range of the value and widest band of each series."""
    value = ticks("forecast_value")
    return forecast.groupBy(*SERIES).agg(
        F.count("*").alias("n_days"), round_mean(F.sum(value), F.count(value), 2).alias("avg_forecast"),
        dround(F.min("forecast_value"), 2).alias("min_forecast"), dround(F.max("forecast_value"), 2).alias("max_forecast"),
        dround(F.min("forecast_lower_80"), 2).alias("min_lower"), dround(F.max("forecast_upper_80"), 2).alias("max_upper"),
    ).orderBy(*SERIES)


def recent_and_forecast(series: DataFrame, forecast: DataFrame, days: int = 90) -> DataFrame:
    """The last days of every series, followed by its forecast with the band."""
    ends = series.groupBy(*SERIES).agg(F.max("ds").alias("_end"))
    recent = series.join(ends, SERIES).filter(F.col("ds") > F.date_sub("_end", days)).select(
        *SERIES, F.col("ds").alias("day"), F.col("y").alias("value"), F.lit(None).cast("double").alias("lower_80"),
        F.lit(None).cast("double").alias("upper_80"), F.lit("history").alias("part"))
    return recent.unionByName(forecast.select(
        *SERIES, F.col("forecast_date").alias("day"), F.col("forecast_value").alias("value"),
        F.col("forecast_lower_80").alias("lower_80"), F.col("forecast_upper_80").alias("upper_80"),
        F.lit("forecast").alias("part")))


def _future(ends: DataFrame, horizon: int) -> DataFrame:
    dates = days_between(F.date_add("_end", 1), F.date_add("_end", horizon))
    return ends.withColumn("forecast_date", F.explode(dates))


def linear_trend(series: DataFrame, horizon: int = FORECAST_HORIZON, digits: int = 6) -> DataFrame:
    """Least-squares line per series, continued over the horizon; the sums are exact."""
    origin = dt.date(1970, 1, 1)
    x = F.datediff("ds", F.lit(origin)).cast("bigint")
    y = ticks("y")
    sums = series.groupBy(*SERIES).agg(
        F.max("ds").alias("_end"), F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    n, sx, sxx = (F.col(c).cast("double") for c in ("n", "sx", "sxx"))
    sy, sxy = (F.col(c).cast("double") / float(SCALE) for c in ("sy", "sxy"))
    line = sums.select(
        *SERIES, "_end", (sx / n).alias("_mx"), (sy / n).alias("_my"),
        F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx).alias("slope"))
    ahead = F.datediff("forecast_date", F.lit(origin)).cast("double") - F.col("_mx")
    return _future(line, horizon).select(
        *SERIES, "forecast_date", dround("slope", digits).alias("slope"),
        dround(F.col("_my") + F.col("slope") * ahead, digits - 2).alias("forecast_value"))


TREND_NAME = "linear trend"


def trend_forecast(series: DataFrame, horizon: int = FORECAST_HORIZON, digits: int = 4) -> DataFrame:
    """The forecast fact from a least-squares line per series, with its closed-form 80 % prediction interval.

    A series folds to seven sums before the shuffle, whatever its length; they are exact whole numbers, and so are their
    differences, so the order of the rows changes nothing. The interval is that of one further value: residual variance (n - 2 degrees of
    freedom) times one plus the uncertainty of level and slope, which grows with the distance from the middle of the history.
    Days count once for each value they have. A series with one day gives no rows, one with two values no band.
    """
    origin = dt.date(1970, 1, 1)
    x, y = F.datediff("ds", F.lit(origin)).cast("bigint"), ticks("y")
    wide = lambda c: c.cast("decimal(19,0)")
    sums = series.filter(y.isNotNull()).groupBy(*SERIES).agg(
        F.max("ds").alias("_end"), F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"),
        F.sum(wide(x) * wide(y)).cast("decimal(19,0)").alias("sxy"), F.sum(wide(y) * wide(y)).alias("syy"))

    def n_times(product: Column, a: str, b: str) -> Column:
        # n squared times the (co)variance
        return (wide(F.col("n")) * product.cast("decimal(19,0)") - wide(F.col(a)) * wide(F.col(b))).cast("double")

    n = F.col("n").cast("double")
    line = sums.select(
        *SERIES, "_end", n.alias("_n"), (F.col("sx").cast("double") / n).alias("_mx"), (F.col("sy").cast("double") / n).alias("_my"),
        n_times(F.col("sxx"), "sx", "sx").alias("_dxx"), n_times(F.col("sxy"), "sx", "sy").alias("_dxy"),
        n_times(F.col("syy"), "sy", "sy").alias("_dyy")).filter(F.col("_dxx") > 0)
    slope = F.col("_dxy") / F.col("_dxx")
    noise = F.when(F.col("_n") > 2, F.greatest(F.lit(0.0), (F.col("_dyy") - F.col("_dxy") * slope) / F.col("_n")) / (F.col("_n") - 2))
    fitted = line.withColumns({"_slope": slope, "_noise": noise})
    ahead = F.datediff("forecast_date", F.lit(origin)).cast("double") - F.col("_mx")
    far = 1.0 + 1.0 / F.col("_n") + ahead * ahead * F.col("_n") / F.col("_dxx")
    value = F.col("_my") + F.col("_slope") * ahead
    half = F.lit(Z80) * F.sqrt(F.col("_noise") * far)
    unit = float(SCALE)
    return _future(fitted, horizon).select(
        "station_id", "forecast_date", "target", dround(value / unit, digits).alias("forecast_value"),
        dround((value - half) / unit, digits).alias("forecast_lower_80"), dround((value + half) / unit, digits).alias("forecast_upper_80"),
        F.lit(TREND_NAME).alias("model_name"))


def seasonal_naive(series: DataFrame, horizon: int = FORECAST_HORIZON, digits: int = 4) -> DataFrame:
    """Mean of the same day of the year over the years before; NULL where no year has the day.

    A series folds to its days of the year (at most 366) and carries them to its future dates.  Its days
    are brought together once, and both steps use that partitioning.
    """
    by_day = series.repartition(*SERIES).groupBy(*SERIES, (F.month("ds") * 100 + F.dayofmonth("ds")).alias("md")).agg(
        F.sum(ticks("y")).alias("s"), F.count("y").alias("n"), F.max("ds").alias("_d"))
    folded = by_day.groupBy(*SERIES).agg(
        F.max("_d").alias("_end"), F.map_from_entries(F.collect_list(F.struct("md", F.struct("s", "n")))).alias("_days"))
    same = F.try_element_at("_days", F.month("forecast_date") * 100 + F.dayofmonth("forecast_date"))
    future = _future(folded, horizon).withColumn("_same", same)
    return future.select(
        *SERIES, "forecast_date", dround(mean(F.col("_same.s"), F.col("_same.n")), digits).alias("forecast_value"),
        F.coalesce("_same.n", F.lit(0)).alias("n_years"))


def require_some(forecast: DataFrame) -> DataFrame:
    """Refuse an empty forecast."""
    if forecast.isEmpty():
        raise RuntimeError("no series could be forecast")
    return forecast
