"""What the corpus operators share: reading, cutting lineage, hashing text, components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obslake.session import cut_lineage

#: Words are separated by these characters, in Spark and DuckDB regular expressions alike.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole ``text`` (null: empty); other columns are left behind, whatever their names."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; the folds of the learning operators."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


class RowIds:
    """Ids of rows within one materialised pass: the partition's number and the row's place in it."""

    def __init__(self) -> None:
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 36

    def take(self, n: int) -> range:
        first, self.next = self.next, self.next + n
        return range(first, first + n)


def batches(rows: list, schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of at most ``size`` rows."""
    for i in range(0, len(rows), size):
        columns = zip(*rows[i:i + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# --- hashes of word runs ----------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SEGMENT = 1 << 20  # bytes hashed at once, so that a text of any length needs the same memory
_state = np.random.default_rng(20240229)
_BYTE = _state.integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], filled, step = 1, 1, base
    while filled < n:  # base**filled is known: double the table
        more = min(filled, n - filled)
        out[filled:filled + more] = out[:more] * np.uint64(step)
        filled += more
        step = step * step & _MASK
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _TABLES["up"] = _powers(_BASE, size)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values; each salt gives another order."""
    x = x ^ np.uint64(salt * 0xD6E8FEB86659FD93 & _MASK)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, in text order; with fewer words, one hash of them all.

    A rolling polynomial over the bytes: the hash of a run is a difference of prefix sums, so a word costs
    the same whatever ``width`` is. Long texts go through in segments.
    """
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return _segment_hashes(words, len(words))
    parts, first, size, i = [], 0, 0, 0
    while i < len(words):
        size += len(words[i]) + 1
        i += 1
        if size >= _SEGMENT and i - first > width and len(words) - i > width:
            parts.append(_segment_hashes(words[first:i], width))
            first, size = i - width + 1, 0
    parts.append(_segment_hashes(words[first:], width))
    return np.concatenate(parts)


def _segment_hashes(words: list[bytes], width: int) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    up, down = _tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1])[:len(words) - width + 1]
    ends = np.concatenate([gaps, [len(data)]])[width - 1:]
    return mix((total[ends] - total[starts]) * down[starts])


# --- components --------------------------------------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``: the smallest node reachable, the node itself included.

    Alternating large-star and small-star steps on the edges, until every component is a star around its smallest node. Every step is a grouped
    minimum (combined before the shuffle) and a join on the node, so a hub with any number of neighbours
    is never one group in a task's memory. Each step is checkpointed. Empty edges give no rows.
    """
    hi, lo = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    current = cut_lineage(edges.where(F.col(a) != F.col(b)).select(hi, lo).distinct())
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node without larger neighbours would lose its own link to the minimum
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).where("u != v")
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        current = cut_lineage(small)
        ends = current.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            current.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or up = 1 and down = 1").isEmpty():
            break
    labels = current.groupBy("u").agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("node")).distinct().join(labels, F.col("node") == F.col("u"), "left_anti")
    return labels.select(F.col("u").alias("node"), "component").union(roots.select("node", F.col("node").alias("component")))
