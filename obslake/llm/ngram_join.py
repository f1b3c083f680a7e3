"""Jaccard self-join on word n-grams by prefix filters under several global orders.

A document is the set of its five-word shingles (as 64-bit hashes; with fewer words, the whole sequence). Two sets of
similarity t or more share a token among the first n - ceil(t n) + 1 of either one, under any global order of the
tokens. Here several orders are used: all put tokens first that are rare in the corpus, each breaks ties its own way. A pair
is a candidate only if it shares prefix tokens under every order, and at places that leave room for the similarity;
of these, pairs whose parity signatures differ in more bits than the similarity allows tokens to differ are left out (a bit
differs only where a token does, so no link is lost). Candidates are then verified on the whole sets.

How rare a token is comes from one pass over all texts: counters addressed by hash, of a fixed number, summed over the tasks. Only
what stands out of a counter's chance load makes a token frequent. The order is a matter of speed: any order gives the same links.

Equal texts are one class from the start (the hash of their word sequence), so copies meet only once. Classes with thousands
of similar texts would still give a square of pairs. Components need fewer: in each star round every class is
verified against a few hubs it shares most prefix tokens with, and linked classes become one component. The last round
verifies every candidate pair of classes that still lie in different components, so no link between components is missed. The links
themselves, all of them, come from ``similar_classes``, which has no star round.

Hash collisions: 64 bits for sequences, shingles and texts of one id, 48 bits for the shingles of one compared pair.

Null and empty texts have no shingles, link with nothing and are their own component. Repeated rows are copies. Only ``doc_id``
and ``text`` are read. Empty input gives no rows. Very long texts are hashed in segments.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.llm.common import WORD, batches, components, mix, shingle_hashes, texts
from obslake.session import cut_lineage

WIDTH = 5
COUNTERS = 1 << 20
_BLOCK = 1 << 12
_BITS = 1 << 24
_SIGNED = 8  # longs of a set's signature
_SEEN = 100_000  # classes whose copies a task leaves out at once
_EARLY = 4  # tokens of a prefix by which a pair knows where it meets first


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _class_of(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


def _sum_blocks(found: DataFrame, blocks: int) -> np.ndarray:
    """Sum of (block, counters) rows: a fixed number of 64-bit counters, whatever the input."""

    def add(key, rows):
        total = np.zeros(_BLOCK, np.int64)
        for data in rows["counters"]:
            total += np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counters": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((blocks, _BLOCK), np.int64)
    for row in found.groupBy("block").applyInArrow(add, "block int, counters binary").toArrow().to_pylist():
        out[row["block"]] = np.frombuffer(row["counters"], np.int64)
    return out.ravel()


def _blocks(total: np.ndarray) -> list[tuple[int, bytes]]:
    parts = total.astype(np.uint32).reshape(-1, _BLOCK)
    return [(i, zlib.compress(part.tobytes(), 1)) for i, part in enumerate(parts) if part.any()]


def _signature(hashes: np.ndarray) -> list[int]:
    """For each of 512 places, whether an odd number of the set's tokens falls there."""
    odd = np.bincount((hashes >> np.uint64(8) & np.uint64(64 * _SIGNED - 1)).astype(np.int64), minlength=64 * _SIGNED) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


_SIGNS = [f"s{i}" for i in range(_SIGNED)]
_DOC = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("block", pa.int32()), ("counters", pa.binary()),
                  *((s, pa.int64()) for s in _SIGNS)])


def _read(docs: DataFrame) -> DataFrame:
    """One pass: a row per document (doc_id, h: hash of its text, n, class, signature), and rows of counters (block, counters)."""

    def run(it):
        total = np.zeros(COUNTERS, np.int64)
        held: list[np.ndarray] = []

        def count() -> None:
            total[:] += np.bincount(np.concatenate(held) >> np.uint64(44), minlength=COUNTERS)
            held.clear()

        for batch in it:
            rows, size = [], 0
            for doc_id, h, text in zip(batch["doc_id"].to_pylist(), batch["h"].to_pylist(), batch["text"], strict=True):
                words = _words(text.as_py())
                hashes = np.unique(shingle_hashes(words, WIDTH))
                rows.append((doc_id, h, len(hashes), _class_of(words) if words else None, None, None, *_signature(hashes)))
                held.append(hashes)
                size += len(hashes)
                if size > 2 * COUNTERS:
                    count()
                    size = 0
            if held:
                count()
            yield from batches(rows, _DOC, 20_000)
        yield from batches([(None, None, None, None, *b, *[None] * _SIGNED) for b in _blocks(total)], _DOC, 64)

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    hashed = hashed.select(F.col("doc_id").cast("long").alias("doc_id"), "h", F.coalesce("text", F.lit("")).alias("text"))
    return hashed.mapInArrow(run, "doc_id long, h long, n long, class long, block int, counters binary, " + ", ".join(f"{s} long" for s in _SIGNS))


def rarity(counters: np.ndarray) -> np.ndarray:
    """0 for tokens whose counter holds no more than chance, else the logarithm of what it holds beyond."""
    mean = counters.mean()
    beyond = counters - mean - 5 * np.sqrt(mean) - 8
    return np.where(beyond > 0, np.floor(np.log2(np.maximum(beyond, 1))) + 1, 0).astype(np.uint8)


def _prefixes(hashes: np.ndarray, rank: np.ndarray, percent: int, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens under each order and their places there; a token's lowest bits hold the order."""
    n = len(hashes)
    size = n - -(-percent * n // 100) + 1
    first = rank[(hashes >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
    out = []
    for k in range(orders):
        tie = mix(hashes, k + 1)
        key = first | (tie >> np.uint64(6))
        at = np.argpartition(key, size - 1)[:size] if size < n else np.arange(n)
        at = at[np.argsort(key[at])]
        out.append((tie[at] & ~np.uint64(3)) | np.uint64(k))
    return np.concatenate(out), np.tile(np.arange(size, dtype=np.int32), orders)


def _postings(docs: DataFrame, rank: np.ndarray, percent: int, orders: int) -> DataFrame:
    """(token, class, n, place) of every prefix token under every order; copies are left out while a task remembers them."""
    sent = docs.sparkSession.sparkContext.broadcast(rank)  # COUNTERS bytes

    def run(it):
        rank, seen = sent.value, set()

        def flush(columns: tuple[list, ...]) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], ["token", "class", "n", "place"])
            for x in columns:
                x.clear()
            return out

        for batch in it:
            columns, size = ([], [], [], []), 0
            for text in batch["text"]:
                words = _words(text.as_py())
                if not words or (which := _class_of(words)) in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(which)
                hashes = np.unique(shingle_hashes(words, WIDTH))
                tokens, places = _prefixes(hashes, rank, percent, orders)
                for column, x in zip(columns, (tokens.view(np.int64), np.full(len(tokens), which, np.int64),
                                               np.full(len(tokens), len(hashes), np.int32), places)):
                    column.append(x)
                size += len(tokens)
                if size > 200_000:
                    yield flush(columns)
                    size = 0
            if size:
                yield flush(columns)

    return texts(docs).select("text").mapInArrow(run, "token long, class long, n int, place int")


def _bits(classes: DataFrame) -> np.ndarray:
    """A bit map of the classes, of a fixed size: it can hold too many, never too few."""

    def run(it):
        total = np.zeros(_BITS // 32, np.uint32)
        for batch in it:
            at = np.asarray(batch["class"]).view(np.uint64) % np.uint64(_BITS)
            np.bitwise_or.at(total, (at >> np.uint64(5)).astype(np.int64), np.uint32(1) << (at & np.uint64(31)).astype(np.uint32))
        yield from batches(_blocks(total), pa.schema([("block", pa.int32()), ("counters", pa.binary())]), 64)

    def either(key, rows):
        total = np.zeros(_BLOCK, np.uint32)
        for data in rows["counters"]:
            total |= np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counters": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((_BITS // 32 // _BLOCK, _BLOCK), np.uint32)
    found = classes.select("class").mapInArrow(run, "block int, counters binary")
    for row in found.groupBy("block").applyInArrow(either, "block int, counters binary").toArrow().to_pylist():
        out[row["block"]] = np.frombuffer(row["counters"], np.uint32)
    return out.ravel()


def pack48(hashes: np.ndarray) -> bytes:
    low = np.unique(hashes & np.uint64((1 << 48) - 1))
    return low.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(class, tokens) of the classes in the bit map, each once."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # _BITS bits

    def run(it):
        bits, seen = sent.value, set()
        for batch in it:
            rows, size = [], 0
            schema = pa.schema([("class", pa.int64()), ("tokens", pa.binary())])
            for text in batch["text"]:
                words = _words(text.as_py())
                if not words:
                    continue
                which = _class_of(words)
                at = which % _BITS
                if which in seen or not int(bits[at >> 5]) >> (at & 31) & 1:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(which)
                rows.append((which, pack48(shingle_hashes(words, WIDTH))))
                size += len(rows[-1][1])
                if size > 1 << 24:
                    yield from batches(rows, schema, 1_000)
                    rows, size = [], 0
            yield from batches(rows, schema, 1_000)

    found = texts(docs).select("text").mapInArrow(run, "class long, tokens binary")
    return found.groupBy("class").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""

    def run(it):
        last, left = b"", np.empty(0, np.uint64)
        for batch in it:
            out = []
            for a, b, x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["x"], batch["y"], strict=True):
                x = x.as_py()
                if x != last:
                    last, left = x, unpack48(x)
                right = unpack48(y.as_py())
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    out.append((a, b))
            yield from batches(out, pa.schema([("a", pa.int64()), ("b", pa.int64())]), 10_000)

    x = sets.select(F.col("class").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _alike(n: Column | str, m: Column | str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _with_components(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with their component, of the lists that still join several components."""
    if labels is None:
        return postings.withColumn("component", F.col("class"))
    known = postings.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    own = Window.partitionBy("token")
    return known.withColumn("lo", F.min("component").over(own)).withColumn("hi", F.max("component").over(own)).where(
        "lo <> hi").drop("lo", "hi")


def _star_pairs(postings: DataFrame, round_: int, hubs: int, percent: int) -> DataFrame:
    """For each class, ``hubs`` times, the hub of another component that it meets in most lists of the first order.

    Every second hub of a list is the class that has the token at its first place: it holds the fewest rare tokens before, so of a
    group of near copies it is one with few changes, which most others are like. The rest are chosen by hash.
    A class that meets a hub in less than a quarter of its prefix is left to the last round.
    """
    own = Window.partitionBy("token")
    by = [F.col("place").cast("long") if i % 2 == 0 else F.xxhash64("component", F.lit(round_ * hubs + i)) for i in range(hubs)]
    chosen = [F.min(F.struct(by[i].alias("h"), F.xxhash64("class", F.lit(round_ * hubs + i)).alias("g"),
                             F.col("class"), F.col("component"), F.col("n"), F.lit(i).alias("i"))).over(own) for i in range(hubs)]
    first = postings.where(F.col("token").bitwiseAND(F.lit(3)) == 0).withColumn("hubs", F.array(*chosen))
    open_ = F.filter("hubs", lambda x: (x["component"] != F.col("component")) & _alike(F.col("n"), x["n"], percent))
    met = first.select(F.col("class").alias("a"), "n", F.explode(open_).alias("hub"))
    met = met.groupBy("a", F.col("hub.class").alias("b"), F.col("hub.i").alias("i")).agg(F.count("*").alias("times"), F.first("n").alias("n"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    best = met.where(F.col("times") * 4 >= prefix).groupBy("a", "i").agg(F.max_by("b", F.struct("times", "b")).alias("b"))
    return best.select("a", "b").distinct()


def _with_early(postings: DataFrame) -> DataFrame:
    """Postings with the first few tokens, by place, that their class still has under the same order: e0, e1 ..."""
    order = F.col("token").bitwiseAND(F.lit(3))
    own = Window.partitionBy("class", order).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return postings.withColumns({f"e{i}": F.nth_value("token", i + 1).over(own) for i in range(_EARLY)})


def _rest_pairs(postings: DataFrame, orders: int, percent: int) -> DataFrame:
    """Every pair of classes of different components that can be similar by its prefixes under all orders.

    Under an order, all tokens that two sets share stand among those from the first shared one on; that bounds the intersection from
    above. Near copies share most of their prefixes, but meet once under an order: at their first common token, where one of both sets'
    early tokens is common. Only pairs that have none there, which share few, meet at every token.
    """
    early = [f"e{i}" for i in range(_EARLY)]
    postings = _with_early(postings)
    a = postings.select("token", F.col("class").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("place").alias("pa"),
                        *(F.col(e).alias(f"a{e}") for e in early))
    b = postings.select("token", F.col("class").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("place").alias("pb"),
                        *(F.col(e).alias(f"b{e}") for e in early))
    # the intersection a pair of these sizes needs, which also shortens both prefixes
    need = F.floor((percent * (F.col("na") + F.col("nb")) + 99 + percent) / (100 + percent))
    near = (F.col("pa") <= F.col("na") - need) & (F.col("pb") <= F.col("nb") - need)
    most = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    first = F.coalesce(*(F.when(F.col(f"a{e}").isin(*(F.col(f"b{x}") for x in early)), F.col(f"a{e}")) for e in early), "token")
    met = a.join(b, "token").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _alike("na", "nb", percent) & near & (most >= need)
                                   & (first == F.col("token")))
    under = F.bit_or(F.expr("shiftleft(1, cast(token & 3 as int))"))
    return met.groupBy("a", "b").agg(under.alias("under")).where(F.col("under") == (1 << orders) - 1).select("a", "b")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can be similar by their signatures, which are a fraction of the sets' size."""
    side = [classes.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), *(F.col(s).alias(f"{s}{x}") for s in _SIGNS)) for x in "ab"]
    differ = sum((F.bit_count(F.col(f"{s}a").bitwiseXOR(F.col(f"{s}b"))) for s in _SIGNS), F.lit(0))
    size = F.col("na") + F.col("nb")
    return pairs.join(side[0], "a").join(side[1], "b").where((100 + percent) * (size - differ) >= 2 * percent * size).select("a", "b")


def _prepared(docs: DataFrame, percent: int, orders: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, h, n, class), classes (class, their smallest doc_id, its smallest h, n, signature) and the postings that several classes share."""
    if not 1 <= orders <= 4:
        raise ValueError("between one and four orders")
    read = cut_lineage(_read(docs))
    rows = read.where("block is null").select("doc_id", "h", "n", "class")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("smallest")
    classes = read.where("class is not null").groupBy("class").agg(smallest, *(F.first(x).alias(x) for x in ("n", *_SIGNS)))
    classes = cut_lineage(classes.select("class", "smallest.doc_id", "smallest.h", "n", *_SIGNS))
    rank = rarity(_sum_blocks(read.where("block is not null").select("block", "counters"), COUNTERS // _BLOCK))
    every = _postings(docs, rank, percent, orders)
    own = Window.partitionBy("token")
    shared = every.withColumn("lo", F.min("class").over(own)).withColumn("hi", F.max("class").over(own)).where("lo <> hi")
    postings = cut_lineage(shared.groupBy("token", "class").agg(F.first("n").alias("n"), F.first("place").alias("place")))
    return rows, classes, postings


def _linked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the candidate pairs (a, b) that are similar."""
    pairs = cut_lineage(_possible(pairs, classes, percent))
    wanted = _bits(pairs.select(F.explode(F.array("a", "b")).alias("class")))
    return cut_lineage(_verified(pairs, _sets(docs, wanted), percent))


def similar_classes(docs: DataFrame, percent: int = 80, orders: int = 2) -> tuple[DataFrame, DataFrame]:
    """The whole join: links (a, b) with a < b between classes of equal word sequences, each once, and members (doc_id, n_shingles, class).

    Every link is there, also within a component; links of copies follow from the members. The output is as large as the number of links.
    Texts without words are members without a class. Empty input gives no rows.
    """
    rows, classes, postings = _prepared(docs, percent, orders)
    links = _linked(docs, _rest_pairs(_with_components(postings, None), orders, percent), classes, percent)
    return links, rows.select("doc_id", F.col("n").alias("n_shingles"), "class")


def _components(docs: DataFrame, percent: int = 80, orders: int = 2, star_rounds: int = 1, hubs: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h, n, class) and classes (class, their smallest doc_id, its smallest h, component)."""
    rows, classes, postings = _prepared(docs, percent, orders)
    links, labels = None, None
    for k in range(star_rounds + 1):
        current = _with_components(postings, labels)
        pairs = _rest_pairs(current, orders, percent) if k == star_rounds else _star_pairs(current, k, hubs, percent)
        found = _linked(docs, pairs, classes, percent)
        links = found if links is None else links.union(found)
        labels = cut_lineage(components(links).select(F.col("node").alias("class"), "component"))

    joined = classes.select("class", "doc_id", "h").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    return rows, joined


def link_components(docs: DataFrame, percent: int = 80, orders: int = 2, star_rounds: int = 1, hubs: int = 4) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    ``orders``: two to four; each costs the prefix tokens of all texts in one shuffle.
    """
    rows, joined = _components(docs, percent, orders, star_rounds, hubs)
    of_component = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = joined.select("class", "component").join(of_component, "component").select("class", "component_id")
    return rows.join(of_class, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` per component, unchanged: that of the smallest doc_id (nulls last), then of the smallest class and text hash.

    Rows are matched by their id and the 64-bit hash of their text, so different texts that share an id, or have none, all stay.
    Rows without words link with nothing: one stays per id, and all that have none.
    """
    members, joined = _components(docs, **settings)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class", "h")).alias("first")
    kept = joined.groupBy("component").agg(first).select("first.doc_id", "first.h")
    kept = kept.union(members.where("class is null and doc_id is not null").groupBy("doc_id").agg(F.min("h").alias("h")))
    # an id as two keys that are never null, for the rank and the join alike, so that texts are sent once
    kept = kept.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("key"), "h")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"),
                       F.coalesce("text", F.lit("")).rlike(WORD).alias("worded"))
    keyed = rows.where("worded or id is not null").select("row", F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("key"), "h")
    same = ["none", "key", "h"]
    one = keyed.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy("h"))).where("place = 1")
    met = one.join(kept, same, "left_semi").select("row")
    return met.union(rows.where("not worded and id is null").select("row")).select("row.*")
