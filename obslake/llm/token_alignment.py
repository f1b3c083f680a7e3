"""Alignment of two tokenizers by lockstep merging of their token ends.

Tokens of both are runs of the same bytes, so a place where tokens of both end cuts the text: between two cuts stands
a group, whose tokens are linked with each other. All documents of a batch are merged at once: one state vector holds a pointer
into A's and one into B's tokens for every lane, each step compares the ends under them, notes the overlapping pair and, where the ends are
equal, a cut, and advances the pointer that lags, or both. Lanes that have ended are compacted away. A document is one lane, or several
if it is long: it is split at blanks before a word, where a token of both always begins.

Words are encoded once and remembered by the worker (a bounded number of short ones). That a blank before a word separates A's tokens follows
from its splitting pattern; for B it is read off the model (no piece has a blank after another character), else texts are encoded whole.

Counts of linked id pairs are collected by chunk, a bounded number of links of consecutive documents: a chunk sends each of its pairs once
with the number of its documents, the sums go back to the chunks that hold the pair, and each chunk adds up its documents. The table of an A id's
highest count has at most one row per entry of A's vocabulary, which is why it may be broadcast. Chunks are written to the shared folder once.
A task holds one batch of tokens and one chunk of links, and whole the links of one document.

Strings of special tokens are plain text. Texts that are null, empty, or not given back by both tokenizers byte by byte (after the blank that B
adds) have no tokens: zeros and an empty digest. Repeated rows are documents of their own; ids can be null or repeated, they are
only carried. Columns other than ``doc_id`` and ``text`` are ignored. Empty input gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from obslake.llm.bpe import byte_names
from obslake.llm.common import texts
from obslake.llm.packing import Tokens
from obslake.session import new_shared_path

BLANK = "▁"  # stands for a blank in B's pieces
LANE = 256  # words of a lane
REMEMBERED = 150_000  # words whose tokens a worker keeps
_UNSAFE = re.compile(r"\A\s| \s| \Z")  # some blank is not the only white space before a word
DENSE = 4_096  # links of a group beyond which its ids are counted before they are paired


class Tokenizers:
    """A (byte-level, ``tokenizers`` file) and B (``sentencepiece`` model): ids of both and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.a = Tokens(path_a)
        self.a.library.encode_special_tokens = True
        self.a.special = []
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        entry = {i: bytes(names[c] for c in s) for s, i in spec["model"]["vocab"].items() if all(c in names for c in s)}
        entry |= {t["id"]: t["content"].encode() for t in spec["added_tokens"] if t["id"] not in entry}
        self.bytes_a = [entry.get(i, b"") for i in range(max(entry) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.by_word = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}

    def encode(self, text: str) -> tuple[bytes, bytes, bool]:
        """32-bit ids of both for a blank and ``text``, and whether both give back its bytes."""
        a, b = self.a.whole(" " + text), np.array(self.b.encode(text), "<u4").tobytes()
        data = (" " + text).encode()
        same = all(b"".join(map(of.__getitem__, np.frombuffer(x, "<u4").tolist())) == data
                   for of, x in ((self.bytes_a, a), (self.bytes_b, b)))
        return a, b, same

    def _stretches(self, text: str) -> list[str]:
        """Parts of ``text`` that no token crosses; a blank stands between them."""
        if not self.by_word:
            return [text]
        parts = text.split(" ")
        if not _UNSAFE.search(text):
            return parts
        out = [parts[0]]
        for before, p in zip(parts, parts[1:]):
            if p and before and not p[0].isspace():
                out.append(p)
            else:  # blanks can be one token of B, other white space one of A
                out[-1] += " " + p
        return out

    def _encode_all(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Encodings of parts, many as one text where that gives the same."""
        data = (" " + " ".join(parts)).encode()
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        found = []
        for ids, size, of in ((self.a.whole(data.decode()), self.size_a, self.bytes_a),
                              (np.array(self.b.encode(data[1:].decode()), "<u4").tobytes(), self.size_b, self.bytes_b)):
            values = np.frombuffer(ids, "<u4")
            reached = np.cumsum(size[values])
            at = np.minimum(np.searchsorted(reached, ends), max(0, len(values) - 1))
            if not len(values) or (reached[at] != ends).any() or b"".join(map(of.__getitem__, values.tolist())) != data:
                return [self.encode(p) for p in parts]
            bounds = (4 * (at + 1)).tolist()
            found.append([ids[a:b] for a, b in zip([0, *bounds], bounds)])
        return [(a, b, True) for a, b in zip(*found)]

    def words(self, docs: list[str]) -> list[list[tuple[bytes, bytes, bool]]]:
        """Of each text the encodings of stretches that no token crosses, in text order; an empty text has none."""
        parts = [self._stretches(text) if text else [] for text in docs]
        new = list(set().union(*parts).difference(self.known))
        plain = [p for p in new if p and not p[0].isspace() and p[-1] != " " and BLANK not in p] if self.by_word else []
        fresh = {p: self.encode(p) for p in set(new).difference(plain)}
        start = size = 0
        for i, p in enumerate(plain):
            size += len(p)
            if size > 1 << 16 or i + 1 == len(plain):
                fresh |= zip(plain[start:i + 1], self._encode_all(plain[start:i + 1]))
                start, size = i + 1, 0
        self.known |= fresh
        out = [list(map(self.known.__getitem__, of)) for of in parts]
        kept = max(0, REMEMBERED - len(self.known) + len(fresh))
        short = set([p for p in plain if len(p) <= 64][:kept])
        for p in fresh:
            if p not in short:
                del self.known[p]
        return out


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, stop_a: np.ndarray,
             with_links: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that begin after each cut (cuts_a, cuts_b) and, if asked for, overlapping tokens (links_a, links_b), in text order.

    ``ends_a`` and ``ends_b`` rise over all lanes; a lane starts at ``at_a``, ``at_b`` and ends where A's pointer reaches ``stop_a``,
    at which place tokens of both end.
    """
    links, cuts = [], []
    some = at_a < stop_a
    pa_, pb_, stop = at_a[some], at_b[some], stop_a[some]
    while len(pa_):
        ea, eb = ends_a[pa_], ends_b[pb_]
        if with_links:
            links.append((pa_, pb_))
        pa_, pb_ = pa_ + (ea <= eb), pb_ + (eb <= ea)
        cut = ea == eb
        cuts.append((pa_[cut], pb_[cut]))
        going = pa_ < stop
        if not going.all():
            pa_, pb_, stop = pa_[going], pb_[going], stop[going]
    cuts_a, cuts_b, links_a, links_b = (
        np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for found in (cuts, links) for i in (0, 1))
    order = np.lexsort((links_b, links_a))
    return np.sort(cuts_a), np.sort(cuts_b), links_a[order], links_b[order]


class Batch:
    """Aligned documents: flat ids of both, where each document starts, and the groups."""

    def __init__(self, enc: Tokenizers, docs: list[str], with_links: bool = False) -> None:
        ids_a, ids_b, lanes_a, lanes_b = [], [], [0], [0]
        first_a, first_b = [0], [0]
        n_a = n_b = 0
        for words in enc.words(docs):
            if all(w[2] for w in words):
                for i in range(0, len(words), LANE):
                    part = words[i:i + LANE]
                    a, b = b"".join([w[0] for w in part]), b"".join([w[1] for w in part])
                    ids_a.append(a)
                    ids_b.append(b)
                    n_a, n_b = n_a + len(a) // 4, n_b + len(b) // 4
                    lanes_a.append(n_a)
                    lanes_b.append(n_b)
            first_a.append(n_a)
            first_b.append(n_b)
        self.a = np.frombuffer(b"".join(ids_a), "<u4").astype(np.int64)
        self.b = np.frombuffer(b"".join(ids_b), "<u4").astype(np.int64)
        self.first_a, self.first_b = np.array(first_a), np.array(first_b)
        starts = np.array(lanes_a)
        self.cuts_a, self.cuts_b, self.links_a, self.links_b = lockstep(
            np.cumsum(enc.size_a[self.a]), np.cumsum(enc.size_b[self.b]), starts[:-1], np.array(lanes_b)[:-1], starts[1:], with_links)
        self.group_a = np.diff(self.cuts_a, prepend=0)  # tokens of A in each group
        self.group_b = np.diff(self.cuts_b, prepend=0)
        self.first_group = np.searchsorted(self.cuts_a, self.first_a, side="right")  # of each document

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per group over each document's groups."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.first_group[1:]] - total[self.first_group[:-1]]

    def pairs(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys document << 2 * bits | a << bits | b of distinct linked pairs, and how often each is linked."""
        doc = np.repeat(np.arange(len(self.first_a) - 1), np.diff(self.first_group))
        size = self.group_a * self.group_b
        start_a, start_b = self.cuts_a - self.group_a, self.cuts_b - self.group_b
        keys, times = [], []
        for one in np.flatnonzero(size > DENSE).tolist():
            a, n = np.unique(self.a[start_a[one]:self.cuts_a[one]], return_counts=True)
            b, m = np.unique(self.b[start_b[one]:self.cuts_b[one]], return_counts=True)
            keys.append((doc[one] << 2 * bits | a[:, None] << bits | b).ravel())
            times.append((n[:, None] * m).ravel())
        rest = np.flatnonzero(size <= DENSE)
        step = max(1, (1 << 21) // max(1, int(size[rest].max(initial=1))))
        bounds = [0]
        total = np.cumsum(size[rest])
        while bounds[-1] < len(rest):  # blocks of about two million links
            reached = total[bounds[-1] - 1] if bounds[-1] else 0
            bounds.append(max(bounds[-1] + step, int(np.searchsorted(total, reached + (1 << 21)))))
        for lo, hi in zip(bounds, bounds[1:]):
            g = rest[lo:hi]
            n = size[g]
            group = np.repeat(g, n)
            place = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            width = self.group_b[group]
            a, b = self.a[start_a[group] + place // width], self.b[start_b[group] + place % width]
            k, t = np.unique(doc[group] << 2 * bits | a << bits | b, return_counts=True)
            keys.append(k)
            times.append(t)
        if len(keys) < 2:
            return (keys[0], times[0]) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))
        found, back = np.unique(np.concatenate(keys), return_inverse=True)
        return found, np.bincount(back, np.concatenate(times), len(found)).astype(np.int64)

    def digests(self) -> list[str]:
        """sha256 of each document's groups as a1,a2|b1;a3|b2, ids in decimal; without tokens the empty string."""
        group_of_a = np.repeat(np.arange(len(self.cuts_a)), self.group_a)
        group_of_b = np.repeat(np.arange(len(self.cuts_b)), self.group_b)
        at_a = np.arange(len(self.a)) + (self.cuts_b - self.group_b)[group_of_a]
        at_b = np.arange(len(self.b)) + self.cuts_a[group_of_b]
        ids, after = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        after[at_a[self.cuts_a - 1]] = ord("|")
        after[at_b[self.cuts_b - 1]] = ord(";")
        width = len(str(int(ids.max(initial=0))))
        digits = np.empty((len(ids), width + 1), np.uint8)
        shown = np.empty((len(ids), width + 1), bool)
        rest = ids.copy()
        for i in range(width - 1, -1, -1):
            shown[:, i] = (rest > 0) | (i == width - 1)
            digits[:, i] = rest % 10 + 48
            rest //= 10
        digits[:, width], shown[:, width] = after, True
        out = digits[shown].tobytes()
        ends = np.concatenate([[0], np.cumsum(shown.sum(1))])
        bounds = ends[self.first_a + self.first_b].tolist()
        return [hashlib.sha256(out[a:b - 1]).hexdigest() if b > a else "" for a, b in zip(bounds, bounds[1:])]


def _batches(it: Iterator[pa.RecordBatch], characters: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts, up to a number of characters at once; a longer text stands alone."""
    for batch in it:
        docs, start, held = batch["text"].to_pylist(), 0, 0
        for i, n in enumerate(map(len, docs)):
            if held and held + n > characters:
                yield batch["doc_id"].slice(start, i - start), docs[start:i]
                start, held = i, 0
            held += n
        if start < len(docs):
            yield batch["doc_id"].slice(start), docs[start:]


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, path_a: str, path_b: str, characters: int = 1 << 20) -> DataFrame:
    """Per document: doc_id, a_ids and b_ids, cuts_a and cuts_b (tokens of A and B before the end of each group), links_a and
    links_b (places of tokens that overlap)."""

    def run(it):
        enc = tokenizers(path_a, path_b)
        for ids, held in _batches(it, characters):
            batch = Batch(enc, held, with_links=True)
            of_links = np.searchsorted(batch.links_a, batch.first_a)
            doc_of_group = np.repeat(np.arange(len(held)), np.diff(batch.first_group))
            doc_of_link = np.repeat(np.arange(len(held)), np.diff(of_links))
            yield pa.RecordBatch.from_arrays([
                ids, _lists(batch.a, batch.first_a), _lists(batch.b, batch.first_b),
                _lists(batch.cuts_a - batch.first_a[doc_of_group], batch.first_group),
                _lists(batch.cuts_b - batch.first_b[doc_of_group], batch.first_group),
                _lists(batch.links_a - batch.first_a[doc_of_link], of_links), _lists(batch.links_b - batch.first_b[doc_of_link], of_links),
            ], ["doc_id", "a_ids", "b_ids", "cuts_a", "cuts_b", "links_a", "links_b"])

    return texts(docs).mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, cuts_a array<int>, cuts_b array<int>, "
                                       "links_a array<int>, links_b array<int>")


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_CHUNKS = f"chunk long, {_DOC}, steps binary, times binary, pair long, n_docs long"
_SCHEMA = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("steps", pa.binary()), ("times", pa.binary()),
                     ("pair", pa.int64()), ("n_docs", pa.int64())])


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _chunked(docs: DataFrame, path_a: str, path_b: str, characters: int, links: int) -> DataFrame:
    """Rows of documents, with their pairs as places in the chunk's sorted list, and rows of a chunk's pairs."""

    def run(it):
        enc = tokenizers(path_a, path_b)
        bits = max(len(enc.bytes_a), len(enc.bytes_b)).bit_length()
        context = TaskContext.get()
        chunk, held, size = (context.partitionId() if context else 0) << 32, [], 0

        def close():
            keys = np.concatenate([k for _, k, _ in held])
            found, back = np.unique(keys, return_inverse=True)
            n_docs = np.bincount(back, minlength=len(found))
            for i in range(0, len(found), 1 << 16):
                part = slice(i, i + (1 << 16))
                pair = found[part] >> bits << 32 | found[part] & (1 << bits) - 1
                yield _rows(len(pair), chunk=np.full(len(pair), chunk), pair=pair, n_docs=n_docs[part])
            places, at = back.astype("<u4"), 0
            for columns, k, times in held:
                bounds = columns.pop("bounds")
                steps = np.diff(places[at:at + len(k)], prepend=np.uint32(0))  # rising within a document
                starts = bounds[:-1][np.diff(bounds) > 0]
                steps[starts] = places[at:at + len(k)][starts]
                at += len(k)
                times = times.astype("<u4")
                parts = list(zip(bounds.tolist(), bounds[1:].tolist()))
                for i in range(0, len(parts), 1_024):
                    of = slice(i, i + 1_024)
                    yield _rows(len(parts[of]), chunk=np.full(len(parts[of]), chunk), **{c: v[of] for c, v in columns.items()},
                                steps=[steps[a:b].tobytes() for a, b in parts[of]], times=[times[a:b].tobytes() for a, b in parts[of]])

        for ids, part in _batches(it, characters):
            batch = Batch(enc, part)
            keys, times = batch.pairs(bits)
            held.append((dict(
                doc_id=ids, n_a=np.diff(batch.first_a), n_b=np.diff(batch.first_b), n_groups=np.diff(batch.first_group),
                n_links=batch.per_doc(batch.group_a * batch.group_b), groups_sha256=batch.digests(),
                bounds=np.searchsorted(keys, np.arange(len(part) + 1) << 2 * bits)), keys & (1 << 2 * bits) - 1, times))
            size += len(keys) + len(part)
            if size >= links:
                yield from close()
                chunk, held, size = chunk + 1, [], 0
        if held:
            yield from close()

    return texts(docs).mapInArrow(run, _CHUNKS)


def link_counts(chunks: DataFrame) -> DataFrame:
    """Per linked pair of ids: pair (a << 32 | b), n (documents that hold it linked), best (n is the highest of its a)."""
    counts = chunks.where("pair is not null").groupBy("pair").agg(F.sum("n_docs").alias("n"))
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("highest"))
    return counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str, characters: int = 1 << 20, links: int = 1 << 21) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    path = new_shared_path(spark, "alignment")
    _chunked(docs, path_a, path_b, characters, links).write.parquet(path)
    chunks, of_docs = (spark.read.schema(_CHUNKS).parquet(path) for _ in range(2))
    known = chunks.where("pair is not null").select("chunk", "pair").join(link_counts(chunks), "pair")
    out = pa.schema([*(_SCHEMA.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), ("n_best", pa.int64()),
                     ("count_sum", pa.int64()), _SCHEMA.field("groups_sha256")])

    def added(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("pair")
        n = pairs["n"].to_numpy()
        best = n * 0 + pairs["best"].to_numpy()
        n_best, count_sum = [], []
        for steps, times in zip(docs["steps"], docs["times"], strict=True):
            at = np.cumsum(np.frombuffer(steps.as_buffer(), "<u4"), dtype=np.int64)
            times = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            n_best.append(int(best[at] @ times))
            count_sum.append(int(n[at] @ times))
        columns = {c: docs[c] for c in out.names if c in docs.column_names} | {
            "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([columns[c] for c in out.names], schema=out)

    rows = of_docs.where("pair is null").select("chunk", *(c.split()[0] for c in _DOC.split(", ")), "steps", "times")
    return rows.groupBy("chunk").cogroup(known.select("chunk", "pair", "n", "best").groupBy("chunk")).applyInArrow(
        added, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
