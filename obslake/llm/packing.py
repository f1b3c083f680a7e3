"""Best-fit packing of token pieces into sequences with a fixed number of open bins.

A document's ids, closed by ``end_id``, are cut into pieces of at most ``length``; only longer documents are cut, and
of those the first piece takes the remainder, so that all others fill a sequence by themselves. Pieces that are not
full are dealt into buckets by a hash, about ``bucket`` pieces each, and every bucket is packed by itself: best fit
among at most ``open_bins`` bins. The bins stand in lists by free space, and one bit per free space says which lists have
any, so the best fit is one shift and one lowest bit. When a bin too many is open, the fullest closes; it can take least.
Only the open bins are held. Pieces arrive in rounds of ``round_size``, within a round the longest first, so that small
ones fill what large ones leave before the bins close (measured against one falling order: 0.1 instead of 20 % waste).

A bucket's size is bounded whatever the input and its order is fixed by hash, length, id and piece, so a lost task repeats
the same bins. Sequences left partly empty are a few per bucket.

Null and empty texts are the single end token. Repeated rows are pieces of their own. Columns other than ``doc_id``
and ``text`` are ignored. Empty input gives no rows.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.bpe import CACHED, PATTERN, byte_names, packed
from obslake.llm.common import RowIds, batches, texts
from obslake.session import cut_lineage


class Tokens:
    """Ids as the ``tokenizers`` library gives them for the vocabulary file, remembering frequent pieces of text.

    What stands between two blanks with other characters beside them is encoded by itself, which no splitting pattern
    of a byte-level vocabulary can tell from encoding the whole. Texts with other white space go to the library whole.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        ranks = {bytes(names[c] for c in s): i for s, i in spec["model"]["vocab"].items() if all(c in names for c in s)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][m] for m in merged]
        # the same merges when ids follow the merge list, which is how ranks are read
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary \
            if order == sorted(order) and len(ranks) == 256 + len(order) else None
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        if self.fast and not any(s in text for s in self.special):
            return packed(self.fast(text))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        known = list(map(self.known.get, rest))
        if None in known:
            if any(s in text for s in self.special):
                return self.whole(text)
            for i, ids in enumerate(known):
                if ids is None:
                    piece = rest[i]
                    if not piece or piece[0].isspace():
                        return self.whole(text)
                    known[i] = ids = packed(self.fast(" " + piece)) if self.fast else self.whole(" " + piece)
                    if len(piece) <= 64 and len(self.known) < CACHED:
                        self.known[piece] = ids
        return self.whole(first) + b"".join(known)


@functools.lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


_PIECE = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    """One row per piece, with the crc32 of its ids; ``uid`` tells rows of the same id apart."""

    def run(it):
        enc, uids = tokens(path), RowIds()
        end = np.array([end_id], "<u4").tobytes()
        for batch in it:
            rows = []
            for doc_id, text, uid in zip(batch["doc_id"].to_pylist(), batch["text"], uids.take(batch.num_rows), strict=True):
                ids = memoryview(enc.encode(text.as_py()) + end)
                n = len(ids) // 4
                first = n % length or length
                bounds = [0, *range(first, n + 1, length)]
                rows += [(uid, doc_id, i, a, b - a, zlib.crc32(ids[4 * a:4 * b]))
                         for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield from batches(rows, _PIECE, 10_000)

    return texts(docs).mapInArrow(run, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: Iterator[int], length: int, open_bins: int) -> Iterator[tuple[int, int]]:
    """For each length in turn: its bin (numbered as they are opened) and its place there."""
    free: list[list[int]] = [[] for _ in range(length + 1)]  # bins by free space
    some = 0  # bit f: a bin has f free
    n_open = n_bins = 0
    for x in lengths:
        fit = some >> x
        if fit:
            f = x + (fit & -fit).bit_length() - 1
            b = free[f].pop()
            if not free[f]:
                some &= ~(1 << f)
            n_open -= 1
        else:
            f, b = length, n_bins
            n_bins += 1
        yield b, length - f
        if f > x:
            free[f - x].append(b)
            some |= 1 << (f - x)
            n_open += 1
            if n_open > open_bins:
                fullest = (some & -some).bit_length() - 1
                free[fullest].pop()
                if not free[fullest]:
                    some &= ~(1 << fullest)
                n_open -= 1


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, open_bins: int = 2_048,
         bucket: int = 16_384, round_size: int = 4_096) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_lineage(cut(docs, path, length, end_id))
    n = pieces.where(F.col("length") < length).count()
    buckets = max(1, -(-n // bucket))
    full = pieces.where(F.col("length") == length).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(key, rows):
        rows = rows.sort_by([("h", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("uid", "ascending")])
        lengths, place = rows["length"].to_numpy(), np.arange(rows.num_rows)
        rows = rows.take(np.lexsort((place, -lengths, place // round_size)))
        bins = list(best_fit(iter(rows["length"].to_pylist()), length, open_bins))
        at = (key[0].as_py() << 24)
        return rows.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array([at + b for b, _ in bins], pa.int64())).append_column(
            "offset", pa.array([o for _, o in bins], pa.int64()))

    rest = pieces.where(F.col("length") < length).withColumn("h", F.xxhash64("doc_id", "piece")).withColumn(
        "bucket", F.pmod(F.xxhash64("uid", "h"), F.lit(buckets)))
    rest = rest.groupBy("bucket").applyInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return full.union(rest)
