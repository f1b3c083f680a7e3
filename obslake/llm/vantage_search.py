"""Nearest neighbours with a vantage-point tree per shard.

A router, itself a small vantage-point tree fitted on at most ``sample`` distinct vectors, cuts the space into cells of about ``shard_rows``
vectors; every vector goes to its cell, and a cell that holds more is dealt into parts by hash, so that no shard grows with a hot
region or with copies. Each task builds the tree of its shard: a node splits its vectors at the median distance to a
vantage point and keeps the span of distances of both halves, a leaf holds ``leaf`` vectors. A query whose distance to the vantage point lies outside a half's span
by a gap can find nothing nearer than that gap there (triangle inequality).

Queries first search their own cell, which gives each a radius, the distance of its k-th neighbour so far. They are then sent to the other
cells whose gap is at most ``factor`` times the radius, and visit nodes by the same rule. Factor one is exact search; a smaller one prunes
what can hold neighbours but seldom does. Every row is indexed and compared in double precision on the original vectors; a
matrix product only sets aside what is far beyond the radius.

The queries of a shard arrive in blocks, the shard once; what a task holds is a shard and one block. The router is broadcast: at most
``max_cells`` vantage points for each length of vector in the sample.

Vectors that are null, empty, zero or hold null or non-finite components are neither queries nor candidates, and vectors of another
length are no candidates. Of all rows only the query's own is left out: a row repeated with the same id is found as a
neighbour, at distance zero. Ties go to the smaller id, ids that are null last. Rows that repeat a query's id are queries of their own, with
rows of their own. Fewer candidates give fewer rows, empty input none. Only vec_id and embedding are read.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.session import cut_lineage

_SLACK = 1e-9  # relative: rounding of distances never decides what is pruned


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` and ``q`` (broadcast against each other)."""
    gap = x - q
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.sqrt((gap * gap).sum(-1))
    if not np.isfinite(out).all():  # squares overflow: scale first
        most = np.abs(gap).max(-1, keepdims=True)
        scaled = gap / np.where((most > 0) & np.isfinite(most), most, 1.0)
        out = np.where(np.isfinite(out), out, np.sqrt((scaled * scaled).sum(-1)) * most[..., 0])
    return out


class Node:
    """An inner node: vantage point and, for each half, the span of its distances and what is below."""

    __slots__ = ("point", "halves")

    def __init__(self, point: np.ndarray, halves: list[tuple[float, float, object]]) -> None:
        self.point, self.halves = point, halves

    def gaps(self, d: np.ndarray) -> list[np.ndarray]:
        """How far each distance lies outside each half's span."""
        return [np.maximum(np.maximum(d - high, low - d), 0.0) for low, high, _ in self.halves]


def build(x: np.ndarray, at: np.ndarray, leaf: int, random: np.random.Generator, depth: int = 60):
    """The tree over the rows ``at`` of ``x``; leaves are arrays of places."""
    if len(at) <= leaf or depth == 0:
        return at
    point = x[at[random.integers(len(at))]]
    d = distances(x[at], point)
    middle = np.partition(d, (len(at) - 1) // 2)[(len(at) - 1) // 2]
    inner = d <= middle
    if inner.all():
        inner = d < middle
        if not inner.any():  # copies, or all equally far
            return at
    return Node(point, [(float(d[half].min()), float(d[half].max()), build(x, at[half], leaf, random, depth - 1)) for half in (inner, ~inner)])


class Found:
    """The ``k`` nearest of each query so far, by distance, then id (null: last)."""

    def __init__(self, n: int, k: int, radius: np.ndarray) -> None:
        self.d = np.full((n, k), np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.at = np.full((n, k), -1)
        self.radius = radius  # never smaller than what can still be beaten

    def offer(self, who: np.ndarray, d: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        k = self.d.shape[1]
        d = np.concatenate([self.d[who], d], 1)
        ids = np.concatenate([self.id[who], np.broadcast_to(ids, (len(who), len(ids)))], 1)
        at = np.concatenate([self.at[who], np.broadcast_to(at, (len(who), len(at)))], 1)
        order = np.lexsort((at, at < 0, ids, d), axis=1)[:, :k]
        self.d[who], self.id[who], self.at[who] = (np.take_along_axis(v, order, 1) for v in (d, ids, at))
        self.radius[who] = np.minimum(self.radius[who], self.d[who, -1])


class Tree:
    """A shard's vectors and their vantage-point tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int, seed: int) -> None:
        self.x, self.ids = x, ids
        with np.errstate(over="ignore"):
            self.squares = (x * x).sum(1)
        self.root = build(x, np.arange(len(x)), leaf, np.random.default_rng([seed, len(x)]))

    def search(self, q: np.ndarray, found: Found, factor: float) -> None:
        """Home leaves first, for a radius, then every node the rule allows."""
        seen: dict[int, np.ndarray] = {}
        self._descend(self.root, np.arange(len(q)), q, found, seen)
        self._visit(self.root, np.arange(len(q)), q, found, factor, seen)

    def _descend(self, node, who, q, found, seen) -> None:
        if not len(who):
            return
        if not isinstance(node, Node):
            self._compare(node, who, q, found)
            seen[id(node)] = who
            return
        near, far = node.gaps(distances(q[who], node.point))
        inner = near <= far
        for half, to in zip(node.halves, (inner, ~inner)):
            self._descend(half[2], who[to], q, found, seen)

    def _visit(self, node, who, q, found, factor, seen) -> None:
        if not len(who):
            return
        if not isinstance(node, Node):
            done = seen.get(id(node))
            self._compare(node, who if done is None else np.setdiff1d(who, done, assume_unique=True), q, found)
            return
        d = distances(q[who], node.point)
        for half, gap in zip(node.halves, node.gaps(d)):
            reach = factor * found.radius[who] * (1 + _SLACK) + _SLACK * d
            self._visit(half[2], who[~(gap > reach)], q, found, factor, seen)

    def _compare(self, at: np.ndarray, who: np.ndarray, q: np.ndarray, found: Found, size: int = 256) -> None:
        for i in range(0, len(at), size):
            part = at[i:i + size]
            x, ask = self.x[part], q[who]
            with np.errstate(over="ignore", invalid="ignore"):
                total = self.squares[part] + (ask * ask).sum(1)[:, None]
                limit = (found.radius[who] * (1 + _SLACK)) ** 2
                maybe = ~(total - 2 * (ask @ x.T) > limit[:, None] + _SLACK * total)
            for s in range(0, len(who), size):  # exact distances for the pairs that may count
                some = maybe[s:s + size]
                rows, cols = some.any(1), some.any(0)
                if rows.any():
                    d = np.where(some[np.ix_(rows, cols)], distances(x[cols][None], ask[s:s + size][rows][:, None]), np.inf)
                    best = part[cols]
                    found.offer(who[s:s + size][rows], d, self.ids[best], best)


# --- router ------------------------------------------------------------------------------------------


class Router:
    """Cells of the space, for one length of vector."""

    def __init__(self, x: np.ndarray, cells: int, seed: int) -> None:
        self.n_cells = 0
        tree = build(x, np.arange(len(x)), max(1, -(-len(x) // cells)), np.random.default_rng(seed)) if cells > 1 and len(x) else np.arange(0)
        self.root = self._numbered(tree)

    def _numbered(self, node):
        if isinstance(node, Node):
            # the sample's spans are no bounds for all vectors: cells meet at the middle between them
            (_, high, inner), (low, _, outer) = node.halves
            middle = (high + low) / 2
            return Node(node.point, [(-np.inf, middle, self._numbered(inner)), (middle, np.inf, self._numbered(outer))])
        self.n_cells += 1
        return self.n_cells - 1

    def home(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)

        def down(node, at):
            if isinstance(node, Node):
                inner = distances(x[at], node.point) <= node.halves[0][1]
                down(node.halves[0][2], at[inner])
                down(node.halves[1][2], at[~inner])
            else:
                out[at] = node

        down(self.root, np.arange(len(x)))
        return out

    def within(self, q: np.ndarray, radius: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, cell) that the rule allows."""
        who, cells = [], []

        def down(node, at):
            if not len(at):
                return
            if isinstance(node, Node):
                d = distances(q[at], node.point)
                reach = factor * radius[at] * (1 + _SLACK) + _SLACK * d
                for half, gap in zip(node.halves, node.gaps(d)):
                    down(half[2], at[~(gap > reach)])
            else:
                who.append(at)
                cells.append(np.full(len(at), node))

        down(self.root, np.arange(len(q)))
        return (np.concatenate(who), np.concatenate(cells)) if who else (np.empty(0, np.int64), np.empty(0, np.int64))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.asarray(pc.list_value_length(batch["embedding"]))
    for size in np.unique(sizes).tolist():
        yield size, batch.filter(pa.array(sizes == size))


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes) -> dict[int, Router]:
    return pickle.loads(data)


def fit_router(vectors: DataFrame, n: int, shard_rows: int, max_cells: int, sample: int, seed: int) -> dict[int, Router]:
    """A router for each length of vector that the sample holds: about ``sample`` distinct vectors, chosen by hash."""
    hashed = vectors.select("embedding", F.xxhash64("embedding", F.lit(seed)).alias("h"))
    if n > sample:
        hashed = hashed.where(F.col("h") < F.lit(int(sample / n * (1 << 64)) - (1 << 63)).cast("long"))
    rows = sorted(hashed.dropDuplicates(["h"]).limit(2 * sample).collect(), key=lambda r: r.h)
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r.embedding), []).append(r.embedding)
    cells = min(max_cells, -(-n // shard_rows))
    return {size: Router(np.array(x, np.float64), round(cells * len(x) / len(rows)), seed) for size, x in by_size.items()}


# --- search ------------------------------------------------------------------------------------------

_SHARD = ["size", "cell", "part"]
_FOUND = pa.schema([("qid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _searched(shards: DataFrame, asked: DataFrame, k: int, factor: float, leaf: int, seed: int, block: int) -> DataFrame:
    """Of each query in each of its shards the ``k`` nearest: qid, vec_id, score."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        vectors, queries = vectors.sort_by("vec_id"), queries.sort_by("qid")
        null = np.asarray(vectors["vec_id"].is_null())
        ids = vectors["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        tree, out = Tree(_matrix(vectors["embedding"]), ids, leaf, seed), []
        for i in range(0, queries.num_rows, block):
            part = queries.slice(i, block)
            found = Found(part.num_rows, k, part["radius"].to_numpy().copy())
            tree.search(_matrix(part["embedding"]), found, factor)
            who, place = np.nonzero(found.at >= 0)
            at = found.at[who, place]
            out.append(pa.table([part["qid"].take(pa.array(who)), pa.array(ids[at], pa.int64(), mask=null[at]),
                                 pa.array(found.d[who, place])], schema=_FOUND))
        return pa.concat_tables(out)

    return shards.groupBy(*_SHARD).cogroup(asked.groupBy(*_SHARD)).applyInArrow(run, "qid long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("qid").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)


def nearest(vectors: DataFrame, asked: Column, k: int = 10, factor: float = 0.25, shard_rows: int = 8_192, leaf: int = 64,
            max_cells: int = 1_024, sample: int = 4_096, seed: int = 7, block: int = 1_024) -> DataFrame:
    """Per row for which ``asked`` (a condition on vec_id) holds, its ``k`` nearest: query_id, rank, vec_id, score."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).where(
        finite & F.exists("embedding", lambda x: x != 0))
    kind = rows.schema["embedding"].dataType.simpleString()
    n = rows.count()
    context = vectors.sparkSession.sparkContext
    routers = context.broadcast(pickle.dumps(fit_router(rows, n, shard_rows, max_cells, sample, seed)))

    def homes(it):
        known = _loaded(routers.value)
        for batch in it:
            for size, part in _by_length(batch):
                cell = known[size].home(_matrix(part["embedding"])) if size in known else np.zeros(part.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, size)), pa.array(cell), part["vec_id"], part["embedding"]],
                                                 ["size", "cell", "vec_id", "embedding"])

    placed = rows.mapInArrow(homes, f"size long, cell long, vec_id long, embedding {kind}")
    # cells that hold more than a shard may: a row for each, at most one per cell of the router and length without one
    full = placed.groupBy("size", "cell").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows).collect()
    parts = {(r.size, r.cell): -(-r.n // shard_rows) for r in full}
    n_parts = F.lit(1)
    if parts:
        table = F.create_map(*[F.lit(x) for (size, cell), p in sorted(parts.items()) for x in (f"{size} {cell}", p)])
        n_parts = F.coalesce(F.try_element_at(table, F.concat_ws(" ", "size", "cell")), F.lit(1))
    shards = placed.withColumn("part", F.pmod(F.xxhash64("embedding", "vec_id", F.lit(seed)), n_parts))
    queries = cut_lineage(placed.where(asked).select(
        F.monotonically_increasing_id().alias("qid"), F.col("vec_id").alias("query_id"), "size", "cell", "embedding"))

    def dealt(df: DataFrame) -> DataFrame:
        """A row for every part of the cell."""
        return df.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))).withColumn("part", F.col("part").cast("long"))

    at_home = queries.select("qid", "size", "cell", F.lit(float("inf")).alias("radius"), "embedding")
    first = cut_lineage(_best(_searched(shards, dealt(at_home), k + 1, factor, leaf, seed, block), k + 1))
    radius = first.where(F.col("place") == k + 1).select("qid", F.col("score").alias("radius"))

    def elsewhere(it):
        known = _loaded(routers.value)
        for batch in it:
            for size, part in _by_length(batch):
                if size in known:
                    who, cell = known[size].within(_matrix(part["embedding"]), part["radius"].to_numpy(), factor)
                    away = cell != part["cell"].to_numpy()[who]
                    taken = part.take(pa.array(who[away]))
                    yield pa.RecordBatch.from_arrays([taken["qid"], taken["size"], pa.array(cell[away]), taken["radius"], taken["embedding"]],
                                                     ["qid", "size", "cell", "radius", "embedding"])

    others = queries.join(radius, "qid", "left").select(
        "qid", "size", "cell", F.coalesce("radius", F.lit(float("inf"))).alias("radius"), "embedding").mapInArrow(
        elsewhere, f"qid long, size long, cell long, radius double, embedding {kind}")
    second = _searched(shards, dealt(others), k + 1, factor, leaf, seed, block)
    found = _best(first.drop("place").union(second), k + 1).join(queries.select("qid", "query_id"), "qid")
    # the query's own row: one at distance zero with its id, if there were not too many others there
    own = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0), F.col("place"))).over(Window.partitionBy("qid"))
    found = found.withColumn("own", own).where("own is null or place != own")
    rank = F.col("place") - F.coalesce((F.col("place") > F.col("own")).cast("int"), F.lit(0))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
