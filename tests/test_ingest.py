import datetime as dt
import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import exports
from obslake.operators.silver import silver, type_rows
from obslake.operators.star import dim_station
from obslake.plans import medallion
from obslake.schema import LOCAL_HEADER, RAW_COLUMNS
from obslake.sources import station_text as text, tables
from obslake.streaming.ingest import ingest_new_exports


@pytest.fixture()
def raw(tmp_path):
    folder = str(tmp_path / "raw")
    exports.write(folder, "STN_CN_01", [
        exports.row("01/01/23", "00:00", Temp_Out="21.5", Out_Hum="NA", Wind_Samp="2.5", Wind_Dir="NNW"),
        exports.row("01/01/23", "00:30", Temp_Out="", Out_Hum="n/a", Rain="abc"),
        exports.row("01/01/23", "00:30", Temp_Out="99.9"),
        exports.row("32/01/23", "01:00", Temp_Out="20.0"),
        exports.row("01/01/23", "---", Temp_Out="20.0"),
        exports.row("29/02/24", "23:30", Temp_Out="-10.1"),
    ])
    exports.write(folder, "STN_VC_02", [exports.row("05/02/23", "12:00", Temp_Out="30.0")], name="Otra")
    return folder


def test_headers_are_dropped_and_missing_cells_are_null(spark, raw):
    rows = text.read_exports(spark, raw)
    assert rows.columns[:38] == RAW_COLUMNS and rows.columns[38:] == ["station_id", "ingestion_ts", "source_file"]
    got = {(r.Date, r.Time, r["Temp Out"], r["Out Hum"], r.station_id, r.source_file) for r in rows.collect()}
    assert got == {
        ("01/01/23", "00:00", "21.5", None, "STN_CN_01", "STN_CN_01.txt"),
        ("01/01/23", "00:30", None, None, "STN_CN_01", "STN_CN_01.txt"),
        ("01/01/23", "00:30", "99.9", None, "STN_CN_01", "STN_CN_01.txt"),
        ("32/01/23", "01:00", "20.0", None, "STN_CN_01", "STN_CN_01.txt"),
        ("01/01/23", None, "20.0", None, "STN_CN_01", "STN_CN_01.txt"),
        ("29/02/24", "23:30", "-10.1", None, "STN_CN_01", "STN_CN_01.txt"),
        ("05/02/23", "12:00", "30.0", None, "STN_VC_02", "STN_VC_02.txt"),
    }


def test_quarantine_and_missing_stations(spark, raw):
    rows = text.read_exports(spark, raw)
    good, bad = text.split_quarantine(rows)
    assert good.count() == 5
    assert {(r.Date, r.source_file) for r in bad.collect()} == {("32/01/23", "STN_CN_01.txt"), ("01/01/23", "STN_CN_01.txt")}
    missing = text.missing_stations(rows, dim_station(spark))
    assert {r.station_id for r in missing.collect()} == {"STN_VI_03", "STN_PA_04"}


def bad_lines(n=0):
    """Junk of one field and of several, 39 cells, an impossible day, a short row."""
    full = exports.row("01/01/23", "00:00", Temp_Out="20.0")
    return ["logger restarted", "logger restarted", "battery\tlow", full + "\tone more", exports.row("32/01/23", "01:00"), "01/01/23\t02:00\t20.0"] + [full] * n


def test_no_line_is_lost(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    exports.write(raw, "STN_CN_01", bad_lines(2))
    exports.write(raw, "STN_VC_02", [], name="Fecha del año")
    with open(f"{raw}/STN_VI_03.txt", "w", encoding="utf-8") as f:  # a part of an export: no header, junk first
        f.write("junk at the start\n\n" + exports.row("05/02/23", "12:00") + "\n")
    medallion.bronze_job(spark, raw, bronze)
    layer = tables.read_layer(spark, bronze, lines=True)
    counts = {(r.station_id, r.kind): r.n_lines for r in text.count_lines(layer).collect()}
    assert counts == {
        ("STN_CN_01", "row"): 3, ("STN_CN_01", "header"): 2, ("STN_CN_01", "name"): 1, ("STN_CN_01", "no_row"): 3,
        ("STN_CN_01", "too_many_cells"): 1, ("STN_CN_01", "bad_instant"): 1, ("STN_VC_02", "header"): 2, ("STN_VC_02", "name"): 1,
        ("STN_VI_03", "no_row"): 1, ("STN_VI_03", "row"): 1}
    bad = sorted((r.kind, r.line, r.source_file) for r in medallion.quarantined(spark, bronze).collect() if r.kind != "bad_instant")
    assert bad == sorted([("no_row", "logger restarted", "STN_CN_01.txt")] * 2 + [("no_row", "battery\tlow", "STN_CN_01.txt"),
                         ("too_many_cells", bad_lines()[3], "STN_CN_01.txt"), ("no_row", "junk at the start", "STN_VI_03.txt")])
    assert tables.read_layer(spark, bronze).count() == 5 and text.read_exports(spark, raw).count() == 5


def test_lines_of_a_stream(spark, tmp_path):
    raw, bronze, progress = (str(tmp_path / n) for n in ("raw", "bronze", "progress"))
    exports.write(raw, "STN_CN_01", bad_lines()[2:])
    exports.write(raw, "STN_VC_02", bad_lines()[:1])
    ingest_new_exports(spark, raw, bronze, progress).awaitTermination(120)
    counts = {(r.station_id, r.kind): r.n_lines for r in text.count_lines(tables.read_layer(spark, bronze, lines=True)).collect()}
    assert counts == {
        ("STN_CN_01", "row"): 1, ("STN_CN_01", "header"): 2, ("STN_CN_01", "name"): 1, ("STN_CN_01", "no_row"): 1,
        ("STN_CN_01", "too_many_cells"): 1, ("STN_CN_01", "bad_instant"): 1,
        ("STN_VC_02", "header"): 2, ("STN_VC_02", "no_row"): 2}  # without places, neither of two can be told for the name


def test_files_of_the_same_name_are_reported_apart(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    for part, n in (("a", 6), ("b", 4)):
        exports.write(f"{raw}/{part}", "STN_CN_01", [exports.row("01/01/23", f"0{i}:00") for i in range(n)])
    medallion.bronze_job(spark, raw, bronze)
    report = text.ingest_report(spark, tables.read_layer(spark, bronze), raw, bronze).collect()
    assert sorted((r.source_file, r.n_rows) for r in report) == [("STN_CN_01.txt", 4), ("STN_CN_01.txt", 6), ("TOTAL", 10)]


def test_increments_take_new_and_changed_files_once(spark, tmp_path):
    raw, bronze, manifest = (str(tmp_path / n) for n in ("raw files", "bronze", "manifest"))
    row = lambda i: exports.row("01/01/23", f"{i:02d}:00", Temp_Out="20.0")
    exports.write(f"{raw}/a", "STN_CN_01", [row(0), row(1)])
    exports.write(f"{raw}/b", "STN_CN_01", [row(2)])
    assert medallion.bronze_increment(spark, raw, bronze, manifest).count() == 2
    assert medallion.bronze_increment(spark, raw, bronze, manifest).count() == 0
    assert tables.read_layer(spark, bronze).count() == 3
    exports.write(f"{raw}/b", "STN_CN_01", [row(2), row(3)])  # grown
    exports.write(f"{raw}/c", "STN_VC_02", [row(4)])
    taken = medallion.bronze_increment(spark, raw, bronze, manifest)
    assert {r.source_path.rsplit("/", 2)[1] for r in taken.collect()} == {"b", "c"}
    layer = tables.read_layer(spark, bronze)
    assert layer.count() == 6 and silver(layer).count() == 5  # the row delivered twice stays once
    assert spark.read.parquet(manifest).count() == 4


def files_of(folder):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if "/station_id=" in f}


def test_an_increment_leaves_other_months_alone(spark, tmp_path, plan):
    raw, bronze, silver_dir, gold, manifest = (str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold", "manifest"))
    for station in ("STN_CN_01", "STN_PA_04"):
        exports.write(f"{raw}/1", station, exports.days(70))
    run = lambda: medallion.increment_job(spark, raw, bronze, silver_dir, gold, manifest)
    assert run().count() == 6 and run().count() == 0
    before = {layer: files_of(layer) for layer in (silver_dir, gold)}
    exports.write(f"{raw}/2", "STN_PA_04", exports.days(1, start="2023-03-20", Temp_Out=lambda d, i: 30.0))
    assert [tuple(r) for r in run().collect()] == [("STN_PA_04", 2023, 3)]
    for layer, old in before.items():
        now = files_of(layer)
        touched = {f for f in old if "station_id=STN_PA_04/year=2023/month=3/" in f}
        assert touched and {f for f in old if now.get(f) == old[f]} == set(old) - touched
    parts = medallion.open_gold(spark, gold)
    # the same as all built at once
    whole = str(tmp_path / "whole")
    medallion.silver_job(spark, bronze, f"{whole}/silver")
    built = medallion.gold_job(spark, f"{whole}/silver", f"{whole}/gold")
    for name in medallion.BY_MONTH:
        columns = sorted(built[name].columns)
        assert sorted(parts[name].columns) == columns
        assert sorted(map(str, parts[name].select(columns).collect())) == sorted(map(str, built[name].select(columns).collect()))
    months = spark.createDataFrame([("STN_PA_04", 2023, 3)], "station_id string, year int, month int")
    some = tables.read_months(spark, silver_dir, months)
    assert "dynamicpruning" in some._jdf.queryExecution().optimizedPlan().toString()
    assert "PartitionFilters: [(year" in plan(some)


def test_jobs_need_no_installed_package(tmp_path):
    """Workers started in an empty folder get the package from the session."""
    root = os.path.abspath(os.path.join(os.path.dirname(__file__), ".."))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from obslake.session import build_session
spark = build_session('ship', 'local[1]', **{{'spark.sql.shuffle.partitions': '1'}})
from obslake.operators import forecast as fc
rows = spark.sql("SELECT 'a' AS station_id, date_add(DATE '2023-01-01', CAST(id AS INT)) AS date_local, id * 1.0D AS temp_avg_c, 2.0D AS etp_total_mm FROM range(50)")
print('forecasts', fc.fact_forecast(rows, 3).count())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
                         capture_output=True, text=True, timeout=240)
    assert "forecasts 6" in out.stdout, out.stderr[-2000:]


def test_typing(spark, raw):
    good, _ = text.split_quarantine(text.read_exports(spark, raw))
    rows = {r.observation_ts: r for r in type_rows(good).filter("station_id = 'STN_CN_01' and temp_out_c is not null").collect()}
    first = rows[dt.datetime(2023, 1, 1)]
    assert (first.temp_out_c, first.humidity_pct, first.wind_samples, first.wind_dir) == (21.5, None, 3, "NNW")
    assert type_rows(good).filter("precip_mm is not null").count() == 0


def test_bronze_is_idempotent_and_partitioned(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        medallion.bronze_job(spark, raw, bronze)
    back = tables.read_layer(spark, bronze)
    assert back.count() == 7 and medallion.quarantined(spark, bronze).count() == 2
    assert os.path.isdir(f"{bronze}/station_id=STN_CN_01/year=2024/month=2")
    counts = tables.partition_counts(back.filter("year is not null"))
    assert {(r.station_id, r.n_partitions) for r in counts.collect()} == {("STN_CN_01", 2), ("STN_VC_02", 1)}
    medallion.bronze_job(spark, raw, bronze, mode="append")
    assert tables.read_layer(spark, bronze).count() == 14
    assert silver(tables.read_layer(spark, bronze).filter("year is not null")).count() == 4
    with pytest.raises(ValueError):
        tables.write_partitioned(back, bronze, mode="ignore")


def test_silver_layer(spark, raw, tmp_path, plan):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    medallion.bronze_job(spark, raw, bronze)
    medallion.silver_job(spark, bronze, out)
    back = tables.read_layer(spark, out)
    assert len(back.columns) == 45 and back.count() == 4
    flags = {(r.station_id, r.observation_ts): r.quality_flag for r in back.collect()}
    assert flags[("STN_CN_01", dt.datetime(2024, 2, 29, 23, 30))] == "temp_out_of_range"
    assert flags[("STN_VC_02", dt.datetime(2023, 2, 5, 12))] is None
    pruned = tables.read_layer(spark, out, dt.date(2024, 1, 1), dt.date(2024, 3, 1), ["STN_CN_01"])
    assert pruned.count() == 1
    scan = plan(pruned)
    assert "PartitionFilters: [isnotnull(station_id" in scan.replace("\n", " ") or "PartitionFilters: [isnotnull(year" in scan
    assert "year#" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_numeric_station_names_keep_their_zeros(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    exports.write(raw, "007", [exports.row("01/01/23", "00:00", Temp_Out="21.5")])
    medallion.bronze_job(spark, raw, bronze)
    assert [r.station_id for r in tables.read_layer(spark, bronze).collect()] == ["007"]


def test_export_writes_what_the_reader_reads(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    rows = text.read_exports(spark, raw)
    text.write_exports(rows, dim_station(spark), out)
    files = glob.glob(f"{out}/station_id=STN_VC_02/*.txt")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines[0] == "Estación Valle Central"
    assert lines[1].split("\t") == RAW_COLUMNS and lines[2].split("\t") == LOCAL_HEADER
    assert lines[3].split("\t")[:4] == ["05/02/23", "12:00", "30.0", "---"]
    again = text.read_exports(spark, out)
    columns = ["station_id", *[f"`{c}`" for c in RAW_COLUMNS]]
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, rows.select(columns).collect()))


@pytest.mark.parametrize("station", ["Estación A:1", "50% + 1", "a%3Ab", "%zz"])
def test_station_ids_survive_export_and_reading(spark, raw, tmp_path, station):
    out = str(tmp_path / "out")
    rows = text.read_exports(spark, raw).withColumn("station_id", F.lit(station))
    text.write_exports(rows, dim_station(spark), out)
    assert {r.station_id for r in text.read_exports(spark, out).select("station_id").collect()} == {station}


def test_large_export_is_in_time_order(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    exports.write(raw, "STN_CN_01", exports.days(40, start="2023-01-20"))
    text.write_exports(text.read_exports(spark, raw).repartition(5), dim_station(spark), out)
    files = glob.glob(f"{out}/station_id=STN_CN_01/*.txt")
    with open(files[0], encoding="utf-8") as f:
        body = f.read().splitlines()[3:]
    stamps = [dt.datetime.strptime(" ".join(line.split("\t")[:2]), "%d/%m/%y %H:%M") for line in body]
    assert len(stamps) == 40 * 48 and stamps == sorted(stamps)


def test_report(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    medallion.bronze_job(spark, raw, bronze)
    report = {r.source_file: r for r in text.ingest_report(spark, text.read_exports(spark, raw), raw, bronze).collect()}
    assert report["STN_CN_01.txt"].n_rows == 6 and report["TOTAL"].n_rows == 7
    size = sum(os.path.getsize(f) for f in glob.glob(f"{raw}/*.txt"))
    stored = sum(os.path.getsize(f) for f in glob.glob(f"{bronze}/**/*.parquet", recursive=True))
    assert report["TOTAL"].bytes == size and report["TOTAL"].table_bytes == stored
    assert report["TOTAL"].compression == pytest.approx(size / stored)


def test_stream_takes_each_file_once(spark, raw, tmp_path):
    bronze, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    ingest_new_exports(spark, raw, bronze, progress).awaitTermination(120)
    assert tables.read_layer(spark, bronze).count() == 7
    ingest_new_exports(spark, raw, bronze, progress).awaitTermination(120)
    exports.write(raw, "STN_VI_03", [exports.row("06/02/23", "12:00", Temp_Out="31.0")])
    ingest_new_exports(spark, raw, bronze, progress).awaitTermination(120)
    back = tables.read_layer(spark, bronze)
    assert back.count() == 8 and back.filter(F.col("station_id") == "STN_VI_03").count() == 1
    batch = text.with_partition_keys(text.read_exports(spark, raw)).drop("ingestion_ts")
    columns = [f"`{c}`" for c in batch.columns]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
