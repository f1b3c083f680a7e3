"""Reading and writing the text exports of the stations.

An export is one UTF-8 file per station, named after it: the station's name, two header lines, then
tab-separated rows with ``---`` for a missing reading.  All files of a folder are read as one splittable scan.

No line is lost.  A line is a row if it has all 38 cells and is no header, or fewer and begins with a date.  Header lines
begin with a header word.  Every other line is kept as text, with its place in the scan: it is the station's name if it
has one field and stands right before a header line of its file; the rest (junk, cells beyond the 38th) is quarantined, like
rows whose instant does not parse.  Lines without any text do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from obslake.functions.clock import has_shape, parse_export_stamp
from obslake.functions.meteo import export_precision
from obslake.schema import (
    HEADER_DATES, LOCAL_HEADER, MISSING_CELLS, MISSING_MARK, RAW_COLUMNS, RAW_SCHEMA, RAW_TO_TYPED,
)

STAMP = "_stamp"
#: Of a line that is no row: its text, and its place among the lines of the scan; and of every line the file's whole path.
OF_LINES = ("line", "place", "source_path")


def _name(c: str) -> Column:
    """A column whose name may hold dots and blanks."""
    return F.col(f"`{c}`")


def _is_header() -> Column:
    return F.coalesce(_name("Date").isin(HEADER_DATES), F.lit(False))


def _is_row() -> Column:
    """All cells, or fewer after a date; ``line`` holds the text of a line with more or fewer."""
    date = F.coalesce(_name("Date"), F.lit(""))
    dated = has_shape(date, "00/00/00") | date.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$")
    fewer = F.length("line") - F.length(F.replace("line", F.lit("\t"), F.lit(""))) < len(RAW_COLUMNS) - 1
    return F.col("line").isNull() | (dated & fewer)


def _cleaned(df: DataFrame) -> DataFrame:
    """Every spelling of a missing cell turned into NULL."""
    return df.withColumns({c: F.when(~_name(c).isin(MISSING_CELLS), _name(c)) for c in RAW_COLUMNS})


def _rows_only(scan: DataFrame) -> DataFrame:
    return _cleaned(scan.filter(~_is_header() & _is_row())).drop(*OF_LINES)


def _parse_options(reader):
    return (
        reader.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField("line", T.StringType())]))
        # all cells are counted, whichever are read: else a line with too few or too many goes unnoticed
        .option("columnPruning", "false").option("columnNameOfCorruptRecord", "line").option("mode", "PERMISSIVE").option("sep", "\t").option("header", "false")
        .option("nullValue", MISSING_MARK).option("encoding", "UTF-8").option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", "true")
    )


def _unescaped(text: Column) -> Column:
    """%XX turned back into characters; a plus sign is one, and what is no escape stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _with_lineage(df: DataFrame) -> DataFrame:
    source, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    # the path is a URI of a folder whose name is escaped itself
    folder = _unescaped(_unescaped(F.substring_index(F.substring_index(path, "station_id=", -1), "/", 1)))
    name = F.left(source, F.length(source) - F.lit(len(".txt")))
    return df.withColumns({
        "station_id": F.when(path.contains("station_id="), folder).otherwise(name),
        "ingestion_ts": F.current_timestamp(),
        "source_file": source,
        "source_path": path,
    })


def _lines_of(scan: DataFrame, place: Column) -> DataFrame:
    """All lines: rows with their cells, others with their text and place and no cells."""
    header, row = _is_header(), _is_row()
    marked = scan.withColumns({"place": place, "_header": header, "_kept": row & ~header})
    cleaned = _cleaned(marked)
    text = F.coalesce("line", F.concat_ws("\t", *[_name(c) for c in RAW_COLUMNS]))
    kept = F.col("_kept")
    # a header line keeps its word, by which it is known
    return cleaned.withColumns({
        **{c: F.when(kept, _name(c)) for c in RAW_COLUMNS if c != "Date"},
        "Date": F.when(kept | F.col("_header"), _name("Date")),
        "line": F.when(~kept, text), "place": F.when(~kept, F.col("place"))}).drop("_header", "_kept")


def read_lines(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """All lines of all exports under a folder, or of the listed files, in one scan: the columns of ``read_exports``, ``line``,
    ``place`` and ``source_path``."""
    return _lines_of(_with_lineage(_parse_options(spark.read).csv(source)), F.monotonically_increasing_id())


def read_exports(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all exports under ``folder``: 38 text columns and where each came from."""
    return _rows_only(_with_lineage(_parse_options(spark.read).csv(folder)))


def read_exports_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The lines of the files that arrive in ``folder``, as ``read_lines`` gives them; a stream knows no place."""
    reader = _parse_options(spark.readStream)
    for key, value in options.items():
        reader = reader.option(key, value)
    return _lines_of(_with_lineage(reader.csv(folder)), F.lit(None).cast("bigint"))


def kinds_of_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``kind``: row, bad_instant, header, name, too_many_cells or no_row.

    ``lines`` are those of ``read_lines`` or ``read_exports_stream`` with ``with_partition_keys``, as written to a table or materialised, since
    places must not change while they are compared.  Only lines that are no rows are compared, by equality of
    file, delivery and place, so a file of nothing but junk is no group of its own.  Where lines have no place, the only
    line of one field in its file is taken for the name.
    """
    other = lines.filter(F.col("line").isNotNull())
    key = ["source_path", "ingestion_ts"]
    header = F.coalesce(F.col("Date").isin(HEADER_DATES), F.lit(False))
    single = ~F.contains("line", F.lit("\t"))
    before = other.filter(header).select(*key, (F.col("place") - 1).alias("place"), F.lit(True).alias("_before_header"))
    alone = other.filter(single & F.col("place").isNull()).groupBy(*key).agg((F.count("*") == 1).alias("_alone"))
    cells = F.length("line") - F.length(F.replace("line", F.lit("\t"), F.lit(""))) + 1
    name = single & F.coalesce("_before_header", F.col("place").isNull() & F.col("_alone"), F.lit(False))
    kind = (F.when(F.col("line").isNull(), F.when(F.col("year").isNull(), "bad_instant").otherwise("row"))
            .when(header, "header").when(name, "name").when(cells > len(RAW_COLUMNS), "too_many_cells").otherwise("no_row"))
    # rows have no place and match nothing
    return lines.join(before, [*key, "place"], "left").join(alone, key, "left").withColumn("kind", kind).drop("_before_header", "_alone")


def count_lines(lines: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """Number of lines of each kind."""
    return kinds_of_lines(lines).groupBy(*by, "kind").agg(F.count("*").alias("n_lines"))


def with_partition_keys(df: DataFrame) -> DataFrame:
    """Add ``year`` and ``month`` of the reading; both are NULL where the instant does not parse."""
    stamped = df.withColumn(STAMP, parse_export_stamp(_name("Date"), _name("Time")))
    return stamped.withColumns({"year": F.year(STAMP), "month": F.month(STAMP)}).drop(STAMP)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a valid instant, and the rest with the file they came from."""
    keyed = with_partition_keys(df)
    return keyed.filter(F.col("year").isNotNull()), keyed.filter(F.col("year").isNull()).drop("year", "month")


def missing_stations(exports: DataFrame, stations: DataFrame) -> DataFrame:
    """Expected stations that delivered no row."""
    return stations.select("station_id").join(exports.select("station_id").distinct(), "station_id", "left_anti")


def file_sizes(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Name, whole path and size of the files under ``folder``; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).load(folder)
    )
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"),
                        F.col("_metadata.file_path").alias("source_path"), F.col("length").alias("bytes"))


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The exports under ``folder`` as they are now: ``source_path``, ``bytes`` and ``modified``; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt").load(folder)
    )
    return files.select(F.col("_metadata.file_path").alias("source_path"), F.col("length").alias("bytes"),
                        F.col("modificationTime").cast("timestamp").alias("modified"))


def new_deliveries(now: DataFrame, taken: DataFrame) -> DataFrame:
    """Deliveries that have not been taken: new files, and files whose size or time has changed since."""
    return now.join(taken, ["source_path", "bytes", "modified"], "left_anti")


def ingest_report(spark: SparkSession, exports: DataFrame, raw_folder: str, table_folder: str) -> DataFrame:
    """Rows per export, and on the last line the totals with the compression reached.

    Files are told apart by ``source_path`` where ``exports`` have it, which they have in the bronze layer, else by name.
    """
    key = "source_path" if "source_path" in exports.columns else "source_file"
    rows = exports.groupBy(key).agg(F.count("*").alias("n_rows"))
    raw = file_sizes(spark, raw_folder, "*.txt")
    per_file = raw.join(rows, key, "left").select(
        "source_file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "bytes")
    stored = file_sizes(spark, table_folder, "*.parquet").agg(F.sum("bytes").alias("b"))
    total = per_file.agg(
        F.lit("TOTAL").alias("source_file"), F.sum("n_rows").alias("n_rows"), F.sum("bytes").alias("bytes"))
    stored_bytes = stored.scalar()
    return per_file.withColumns({
        "table_bytes": F.lit(None).cast("bigint"), "compression": F.lit(None).cast("double"),
    }).unionByName(total.withColumns({
        "table_bytes": stored_bytes, "compression": F.try_divide(F.col("bytes").cast("double"), stored_bytes),
    }))


def export_cells(typed: DataFrame) -> DataFrame:
    """Typed observations as the text cells of an export, at the decimals it keeps.

    Columns the frame does not have are missing in the export.
    """
    have = set(typed.columns)
    stamp = F.col("observation_ts")

    def cell(typed_name: str, kind: str) -> Column:
        if typed_name not in have:
            return F.lit(None).cast("string")
        value = export_precision(typed_name) if kind == "double" else F.col(typed_name)
        return value.cast("string")

    return typed.select(
        "station_id", F.date_format(stamp, "dd/MM/yy").alias("Date"), F.date_format(stamp, "HH:mm").alias("Time"),
        *[cell(name, kind).alias(raw) for raw, name, kind, _ in RAW_TO_TYPED[2:]])


def write_exports(raw: DataFrame, stations: DataFrame, folder: str) -> None:
    """Write the 38 text columns back as exports, one folder ``station_id=…`` per station.

    A station's text starts with its three header lines and goes on in time order.  Adaptive execution
    cuts a station that holds most of the rows into several files; the reader knows header lines by
    content, so only the first of them has any.
    """
    body = raw.select(
        "station_id", F.lit(3).alias("_line"), parse_export_stamp(_name("Date"), _name("Time")).alias(STAMP),
        F.concat_ws("\t", *[F.coalesce(_name(c), F.lit(MISSING_MARK)) for c in RAW_COLUMNS]).alias("value"),
    )
    texts = [F.col("station_name"), F.lit("\t".join(RAW_COLUMNS)), F.lit("\t".join(LOCAL_HEADER))]
    present = stations.join(raw.select("station_id").distinct(), "station_id", "left_semi")
    heads = present.select("station_id", F.posexplode(F.array(*texts)).alias("_line", "value")).withColumn(
        STAMP, F.lit(None).cast("timestamp_ntz"))
    lines = heads.unionByName(body).hint("rebalance", "station_id")
    (
        lines.sortWithinPartitions("station_id", "_line", STAMP).select("station_id", "value")
        .write.mode("overwrite").partitionBy("station_id").text(folder)
    )
