"""Incremental ingestion: only the exports that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from obslake.sources.station_text import read_exports_stream, with_partition_keys
from obslake.sources.tables import STATION_MONTH


def ingest_new_exports(
    spark: SparkSession, raw: str, bronze: str, progress: str, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append the rows of new files to the bronze layer, exactly once, and stop when all are in.

    ``progress`` remembers the files already taken.  The layer has the layout of the batch job; a folder
    written by the stream should be written by the stream only, since its log says which files count.
    """
    stream = with_partition_keys(read_exports_stream(spark, raw, maxFilesPerTrigger=str(files_per_batch)))
    return (
        stream.writeStream.format("parquet").option("path", bronze).option("checkpointLocation", progress)
        .option("compression", "snappy").partitionBy(*STATION_MONTH).trigger(availableNow=True).start()
    )
