"""The five jobs from station exports to the forecast table, each reading what the one before wrote."""

from __future__ import annotations

import argparse
import datetime as dt
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake import schema
from obslake.operators import forecast as fc, star
from obslake.operators.calendar import dim_date
from obslake.operators.dedup import duplicate_keys
from obslake.operators.events import extreme_events
from obslake.operators.silver import profile, silver
from obslake.session import build_session, cut_lineage
from obslake.sources import station_text as text, tables

FACTS = ["dim_station", "dim_date", "fact_observations_30min", "fact_daily_summary", "fact_monthly_summary",
         "fact_extreme_events"]

BY_MONTH = ["fact_observations_30min", "fact_daily_summary", "fact_monthly_summary"]


def bronze_job(spark: SparkSession, raw: str, bronze: str, mode: str = "overwrite", stations=None) -> None:
    """Exports to Parquet, one folder per station, year and month.

    The text is read once.  Rows whose instant does not parse and lines that are no rows stay in the layer, in the
    folders without a year; ``quarantined`` lists them.
    """
    lines = tables.only(text.read_lines(spark, raw), "station_id", stations)
    tables.write_partitioned(text.with_partition_keys(lines), bronze, mode=mode)


def _new_files(spark: SparkSession, raw: str, manifest: str) -> tuple[DataFrame, list[str]]:
    """Manifest rows of the exports that are new or changed, and their paths, which the scan needs to plan its splits."""
    columns = "source_path string, bytes long, modified timestamp"
    try:
        taken = spark.read.schema(columns).parquet(manifest)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        taken = spark.createDataFrame([], columns)
    new = cut_lineage(text.new_deliveries(text.deliveries(spark, raw), taken))
    return new, [unquote(r.source_path) for r in new.select("source_path").toLocalIterator()]


def _append(spark: SparkSession, paths: list[str], bronze: str, stations) -> DataFrame:
    lines = text.with_partition_keys(tables.only(text.read_lines(spark, paths), "station_id", stations))
    tables.write_partitioned(lines, bronze, mode="append")
    return lines


def _remember(new: DataFrame, manifest: str) -> None:
    new.coalesce(1).write.mode("append").parquet(manifest)


def bronze_increment(spark: SparkSession, raw: str, bronze: str, manifest: str, stations=None) -> DataFrame:
    """Append the exports that are new or changed since the last increment; returns their manifest rows.

    ``manifest`` is a table of the files taken, by path, size and time, written last: a run that is lost before is
    repeated, and the typed layer removes what came twice. Only the new files are opened.
    """
    new, paths = _new_files(spark, raw, manifest)
    if paths:
        _append(spark, paths, bronze, stations)
        _remember(new, manifest)
    return new


def quarantined(spark: SparkSession, bronze: str) -> DataFrame:
    """Ingested lines that are neither headers nor rows with a valid instant: cells or text, the file, and why (``kind``)."""
    aside = tables.read_layer(spark, bronze, lines=True).filter(F.col("year").isNull())
    return text.kinds_of_lines(aside).filter(~F.col("kind").isin("header", "name"))


def silver_job(
    spark: SparkSession, bronze: str, out: str, start: dt.date | None = None, end: dt.date | None = None,
) -> None:
    """Typed, deduplicated and flagged observations; a range rebuilds only its months."""
    first = start.replace(day=1) if start else None
    last = (end.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1) if end else None
    rows = tables.read_layer(spark, bronze, first, last).filter(F.col("year").isNotNull())
    tables.write_partitioned(silver(rows), out)


def silver_months(spark: SparkSession, bronze: str, out: str, months: DataFrame) -> None:
    """Rebuild the station-months listed; no other folder is opened or written."""
    rows = tables.read_months(spark, bronze, months).filter(F.col("year").isNotNull())
    tables.write_partitioned(silver(rows), out)


def gold_job(
    spark: SparkSession, silver_dir: str, gold: str, stations=schema.STATIONS, calendar_range=schema.CALENDAR_RANGE,
    months: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the star schema; every table is computed from the written table below it.

    The facts lie by station, year and month. With ``months`` only those station-months of them are rebuilt;
    dimensions, and events, whose numbers run over the whole history, always are.
    """
    out = {"dim_station": tables.write_table(star.dim_station(spark, stations), gold, "dim_station")}
    if not duplicate_keys(out["dim_station"], ["station_id"]).isEmpty():
        raise ValueError("station_id must be unique")
    out["dim_date"] = tables.write_table(dim_date(spark, *calendar_range), gold, "dim_date")
    part = months is not None

    def touched(name: str, fact: DataFrame) -> DataFrame:
        path = f"{gold.rstrip('/')}/{name}"
        return tables.read_months(spark, path, months).select(*fact.columns) if part else fact

    observed = tables.write_fact(
        star.fact_observations(tables.read_months(spark, silver_dir, months)), gold, "fact_observations_30min", part)
    daily = tables.write_fact(
        star.fact_daily_summary(touched("fact_observations_30min", observed)), gold, "fact_daily_summary", part)
    monthly = tables.write_fact(
        star.fact_monthly_summary(touched("fact_daily_summary", daily)), gold, "fact_monthly_summary", part)
    out |= {"fact_observations_30min": observed, "fact_daily_summary": daily, "fact_monthly_summary": monthly}
    events = extreme_events(out["fact_daily_summary"])
    out["fact_extreme_events"] = tables.write_table(events, gold, "fact_extreme_events")
    register(spark, out)
    return out


def increment_job(
    spark: SparkSession, raw: str, bronze: str, silver_dir: str, gold: str, manifest: str, stations=schema.STATIONS, **options,
) -> DataFrame:
    """New exports through all layers: only the station-months they touch are rebuilt, which are returned.

    The files count as taken once all layers are written, so a run that is lost is repeated from the start. To know the
    months, the new files are read a second time, and no old ones.
    """
    new, paths = _new_files(spark, raw, manifest)
    if not paths:
        return spark.createDataFrame([], "station_id string, year int, month int")
    months = cut_lineage(tables.months_of(_append(spark, paths, bronze, None)))
    if not months.isEmpty():
        silver_months(spark, bronze, silver_dir, months)
        gold_job(spark, silver_dir, gold, stations, months=months, **options)
    _remember(new, manifest)
    return months


def register(spark: SparkSession, gold: dict[str, DataFrame]) -> None:
    """Make the tables and the joined daily view queryable by name."""
    for name, df in gold.items():
        tables.register_view(df, name)
    view = star.join_dimensions(gold["fact_daily_summary"], gold["dim_station"], gold["dim_date"])
    tables.register_view(view, "vw_daily_climate")


def open_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The tables a gold job wrote earlier."""
    def table(name: str) -> DataFrame:
        path = f"{gold.rstrip('/')}/{name}"
        if name not in BY_MONTH:
            return spark.read.parquet(path)
        fact = tables.read_layer(spark, path)
        keys = () if name == "fact_monthly_summary" else ("year", "month")
        return fact.select("station_id", *[c for c in fact.columns if c not in ("station_id", *keys)])

    return {name: table(name) for name in FACTS}


def forecast_job(spark: SparkSession, gold: str, horizon: int = schema.FORECAST_HORIZON) -> tuple[DataFrame, DataFrame]:
    """Fit every series once; write the forecasts, and the series that failed with the reason."""
    daily = open_gold(spark, gold)["fact_daily_summary"]
    fitted = cut_lineage(fc.fit_all(fc.history(daily), horizon))
    good, failed = fc.split_failures(fitted)
    fc.require_some(good)
    forecast = tables.register_view(tables.write_table(good, gold, "fact_forecast"), "fact_forecast")
    return forecast, tables.write_table(failed, gold, "forecast_failures")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="obslake")
    steps = parser.add_subparsers(dest="step", required=True)
    for name, source, target in [
        ("bronze", "data/raw", "data/bronze"), ("silver", "data/bronze", "data/silver/observations"),
        ("gold", "data/silver/observations", "data/gold"),
    ]:
        step = steps.add_parser(name)
        step.add_argument("--in", dest="source", default=source)
        step.add_argument("--out", dest="target", default=target)
        if name == "bronze":
            step.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
            step.add_argument("--manifest", help="append only exports that this table does not list yet")
            step.add_argument("--stations", default="all")
    step = steps.add_parser("forecast")
    step.add_argument("--gold", default="data/gold")
    step.add_argument("--horizon", type=int, default=schema.FORECAST_HORIZON)
    args = parser.parse_args(argv)

    spark = build_session()
    if args.step == "bronze":
        chosen = None if args.stations == "all" else args.stations.split(",")
        if args.manifest:
            bronze_increment(spark, args.source, args.target, args.manifest, chosen)
        else:
            bronze_job(spark, args.source, args.target, args.mode, chosen)
        written = tables.read_layer(spark, args.target)
        text.ingest_report(spark, written, args.source, args.target).show(100, False)
        text.count_lines(tables.read_layer(spark, args.target, lines=True)).orderBy("station_id", "kind").show(1000, False)
        expected = star.dim_station(spark, schema.STATIONS)
        text.missing_stations(written, tables.only(expected, "station_id", chosen)).show(100, False)
    elif args.step == "silver":
        silver_job(spark, args.source, args.target)
        profile(tables.read_layer(spark, args.target)).show(100, False)
    elif args.step == "gold":
        tables.row_counts(gold_job(spark, args.source, args.target)).show(100, False)
    else:
        forecast, failed = forecast_job(spark, args.gold, args.horizon)
        fc.summary(forecast).show(100, False)
        failed.show(100, False)


if __name__ == "__main__":
    main()
