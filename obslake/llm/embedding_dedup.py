"""Near-duplicate vectors by Euclidean p-stable hashing, with an exact cosine check.

Vectors are scaled to length one, so a cosine is a distance. Each of ``tables`` hash tables quantises ``projections`` Gaussian
projections, shifted at random, in steps of ``width``; vectors of a bucket are compared by cosine in double precision, and only
pairs at or above ``threshold`` link. With the defaults a pair at cosine 0.93 meets in some table with probability 0.996,
closer ones more surely. All vectors are indexed; nothing is sampled.

Equal vectors of a label are one class with a number of copies, which meet no other way. A pair that meets in several tables counts in
the first: each row carries its keys of all tables. A bucket of more than ``block`` classes is dealt into cells, each the
meeting of two blocks, so that no task holds more than two blocks; the cells give, for each class, the number of links
and one link of a spanning forest, never the pairs themselves.

Rows whose label is null, or whose vector is null, empty, zero or has null or non-finite components, link with nothing:
no links, own component, kept. Vectors of different lengths are not compared. Repeated rows are copies of each other (one with the smallest id
is kept). Links are those of a row's own vector and label, whatever its id: ids can be null or clash. The component is the smallest id in it,
null if it has none, and the rows of that id in it are kept. Only vec_id, embedding and label are read. Empty input gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import components
from obslake.session import cut_lineage


@functools.lru_cache(maxsize=4)
def _projections(size: int, tables: int, projections: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng([seed, size])
    return (random.standard_normal((size, tables * projections)), random.uniform(0, width, tables * projections),
            random.integers(1, 1 << 63, projections, dtype=np.uint64) | np.uint64(1))


def keys_of(unit: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """A 32-bit key per row and table."""
    normal, shift, odd = _projections(unit.shape[1], tables, projections, width, seed)
    steps = np.floor((unit @ normal + shift) / width).astype(np.int64).view(np.uint64).reshape(len(unit), tables, projections)
    return ((steps * odd).sum(2, dtype=np.uint64) * odd[0] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _linked(unit: np.ndarray, side: np.ndarray, keys: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of a cell that link and meet here first; ``side``: 0 or 1 if only pairs across count, else -1."""
    a = np.flatnonzero(side <= 0)
    b = a if side[0] < 0 else np.flatnonzero(side == 1)
    i, j = np.nonzero(unit[a] @ unit[b].T >= threshold)
    i, j = a[i], b[j]
    if side[0] < 0:
        i, j = i[i < j], j[i < j]
    if table and len(i):
        new = np.ones(len(i), bool)
        for s in range(0, len(i), 1 << 18):
            part = slice(s, s + (1 << 18))
            new[part] = ~(keys[i[part], :table] == keys[j[part], :table]).any(1)
        i, j = i[new], j[new]
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each place."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def link_vectors(vectors: DataFrame, threshold: float = 0.93, tables: int = 24, projections: int = 7, width: float = 1.5,
                 seed: int = 11, block: int = 2_048) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    fit = F.coalesce(finite & some & F.col("label").isNotNull(), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    rows = rows.withColumn("fit", fit).withColumn("h", F.xxhash64("embedding")).withColumn("g", F.hash("embedding"))
    classes = rows.where("fit").groupBy("label", "h", "g").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # label by its hash: any type of label is compared by equality, and buckets carry a fixed width
    classes = classes.withColumn("space", F.xxhash64("label", F.size("embedding")))
    # numbered once, as materialised: ids can be null, or stand for several vectors and labels
    classes = cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()))

    def hashed(it):
        for batch in it:
            by_size: dict[int, list[int]] = {}
            lists = [np.asarray(v.values) for v in batch["embedding"]]
            for i, v in enumerate(lists):
                by_size.setdefault(len(v), []).append(i)
            for size, at in by_size.items():
                for s in range(0, len(at), 1_000):
                    part = at[s:s + 1_000]
                    x = np.stack([lists[i] for i in part])
                    x = x / np.abs(x).max(1, keepdims=True)  # squares neither over- nor underflow
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    keys = keys_of(unit, tables, projections, width, seed)
                    for name in ("class", "copies", "space"):
                        assert batch[name].null_count == 0
                    taken = batch.take(pa.array(part))
                    many = np.repeat(np.arange(len(part)), tables)
                    yield pa.RecordBatch.from_arrays([
                        taken["space"].take(pa.array(many)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))),
                        pa.array(keys.ravel()), taken["class"].take(pa.array(many)), taken["copies"].take(pa.array(many)),
                        pa.array([keys[i].tobytes() for i in many], pa.binary()), pa.array([unit[i].tobytes() for i in many], pa.binary()),
                    ], ["space", "at", "key", "class", "copies", "keys", "unit"])

    met = classes.select("class", "copies", "space", "embedding").mapInArrow(
        hashed, "space long, at int, key int, class long, copies long, keys binary, unit binary")
    bucket = ["space", "at", "key"]
    sizes = met.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    met = met.join(sizes, bucket).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("class", F.lit(seed)), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("cell", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).withColumn(
        "side", F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))
    group = [*bucket, "cell"]

    def compared(it):
        def links(table: pa.Table) -> pa.RecordBatch | None:
            unit = np.stack([np.frombuffer(u.as_py()) for u in table["unit"]])
            keys = np.stack([np.frombuffer(k.as_py(), np.int32) for k in table["keys"]])
            i, j = _linked(unit, table["side"].to_numpy(), keys, table["at"][0].as_py(), threshold)
            if not len(i):
                return None
            copies, which = table["copies"].to_numpy(), table["class"].to_numpy()
            n = np.bincount(i, copies[j], len(which)) + np.bincount(j, copies[i], len(which))
            at = np.unique(np.concatenate([i, j]))
            root = which[_forest(len(which), i, j)]
            return pa.RecordBatch.from_arrays([pa.array(which[at]), pa.array(n[at].astype(np.int64)), pa.array(root[at])], ["class", "links", "root"])

        held: list[pa.RecordBatch] = []
        for batch in it:  # sorted: a cell's rows stand together
            ids = [batch[c].to_numpy() for c in group]
            change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
            bounds = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                part = batch.slice(a, b - a)
                if held and any(held[0][c][0] != part[c][0] for c in group):
                    if (out := links(pa.Table.from_batches(held))) is not None and sum(x.num_rows for x in held) > 1:
                        yield out
                    held = []
                held.append(part)
        if held and (out := links(pa.Table.from_batches(held))) is not None:
            yield out

    dealt = met.select(*group, "side", "class", "copies", "keys", "unit").repartition(*[F.col(c) for c in group])
    found = cut_lineage(dealt.sortWithinPartitions(*group).mapInArrow(compared, "class long, links long, root long"))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    of_class = classes.select(F.col("label").alias("l"), F.col("h").alias("lh"), F.col("g").alias("lg"), "class", "copies", "first_id").join(
        links, "class", "left").join(labels.withColumnRenamed("node", "class"), "class", "left")
    alone = of_class.where("component is null").withColumn("component_id", F.col("first_id"))
    linked = of_class.where("component is not null")
    linked = linked.join(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "component")
    columns = ["l", "lh", "lg", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"]
    of_class = alone.select(*columns).union(linked.select(*columns))
    same = F.col("fit") & F.col("label").eqNullSafe(F.col("l")) & (F.col("h") == F.col("lh")) & (F.col("g") == F.col("lg"))
    return rows.select("vec_id", "label", "h", "g", "fit").join(of_class, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
