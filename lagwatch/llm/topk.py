"""Exact top-k search by inner product, over one KD-tree per shard.

Every vector is indexed. A task cuts the rows it reads into shards of at most SHARD_VALUES numbers and
builds a tree of each: median splits of the widest side, a tight box and the smallest id for every node.
Trees are written once. Shards are dealt over lanes, and a query visits the lanes in waves that grow
GROWTH-fold: the scores found so far travel with it, so its k-th score prunes from the first tree
of the next wave on. Inside a tree, nodes are visited best first by the bound of their box,
``sum(max(q * low, q * high))``, until no bound reaches the k-th score. A box whose bound equals it is
visited only if it holds a smaller id than the k-th.

Queries are taken in blocks of at most BLOCK_VALUES numbers, so what a task holds is one block
and one tree at a time. Nothing is broadcast and nothing but counts reaches the driver.

Defined results: components become ``floor(1024 * x)``; a row takes no part if its id or vector is null or
a component is null, not finite, or not finite after the product. Vectors of different length are
not compared. Scores beyond the range of a long are cut off at its ends. Every candidate row
counts, repeated ones too, but no row with the query's own id. Of several query rows with one id the
smallest vector is searched.
"""

from __future__ import annotations

import heapq
import pickle
from bisect import insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, stage

K = 10
SCALE = 1024
SHARD_VALUES = 1 << 17
BLOCK_VALUES = 1 << 20
LEAF = 64
GROWTH = 8
#: Shards that share a lane, at least.
LANE_SHARDS = 4
_LONG = (-(1 << 63), (1 << 63) - 1)
_EXACT = float(1 << 53)

_TREES = "shard long, dims int, tree binary"
_FOUND = "query_id long, vec_id long, score long"


def layout(n: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, end row and left child (-1 for a leaf; the right one follows it) of each node of a tree of n rows."""
    start, stop, child = [0], [n], [-1]
    node = 0
    while node < len(start):
        a, b = start[node], stop[node]
        if b - a > leaf:
            child[node] = len(start)
            start += [a, (a + b) // 2]
            stop += [(a + b) // 2, b]
            child += [-1, -1]
        node += 1
    return np.array(start), np.array(stop), np.array(child)


def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Rows in tree order, with the box and the least id of each node."""
    start, stop, child = layout(len(points), leaf)
    order = np.arange(len(points))
    low, high = np.empty((2, len(start), points.shape[1]))
    least = np.empty(len(start), np.int64)
    for node, (a, b) in enumerate(zip(start, stop, strict=True)):
        rows = order[a:b]
        inside = points[rows]
        low[node], high[node], least[node] = inside.min(0), inside.max(0), ids[rows].min()
        if child[node] >= 0 and points.shape[1]:
            side = int(np.argmax(high[node] - low[node]))
            order[a:b] = rows[np.argpartition(inside[:, side], (b - a) // 2)]
    tree = {"points": points[order], "ids": ids[order], "low": low, "high": high, "least": least}
    for kind in (np.int16, np.int32):  # the smallest type that holds the numbers
        if not points.size or np.abs(points).max() <= np.iinfo(kind).max:
            return tree | {name: tree[name].astype(kind) for name in ("points", "low", "high")}
    return tree


class Best:
    """The k best rows of one query so far, as ascending (-score, id, fresh)."""

    __slots__ = ("k", "rows", "own", "score", "least_id")

    def __init__(self, own: int, k: int, known: list[tuple[int, int]]):
        self.own, self.k = own, k
        self.rows = sorted((-s, i, False) for s, i in known)
        self._limit()

    def _limit(self) -> None:
        """Score and id that a further row has to beat."""
        del self.rows[self.k :]
        full = len(self.rows) >= self.k
        self.score, self.least_id = (-self.rows[-1][0], self.rows[-1][1]) if full else (_LONG[0], _LONG[1])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        wanted = np.flatnonzero((scores >= self.score) & (ids != self.own))
        if not len(wanted):
            return
        for score, row in zip(scores[wanted].tolist(), ids[wanted].tolist(), strict=True):
            if score > self.score or (score == self.score and row < self.least_id):
                insort(self.rows, (-int(score), row, True))
                self._limit()


def _whole(values: np.ndarray) -> np.ndarray:
    """Python integers, for products that a double cannot hold."""
    return np.frompyfunc(int, 1, 1)(values).astype(object)


def search(tree: dict[str, np.ndarray], queries: np.ndarray, best: list[Best], leaf: int = LEAF) -> None:
    """Best-first search of one tree for each query; ``best`` is brought up to date in place."""
    start, stop, child = (x.tolist() for x in layout(len(tree["points"]), leaf))
    points, low, high = (tree[name].astype(np.float64) for name in ("points", "low", "high"))
    ids, least = tree["ids"], tree["least"].tolist()
    largest = [np.abs(x).max() if x.size else 0.0 for x in (points, queries)]
    if points.shape[1] * largest[0] * largest[1] < _EXACT:
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    else:
        points, low, high, queries = (_whole(x) for x in (points, low, high, queries))
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        bounds = np.clip(bounds, *_LONG)
    for query, bound, top in zip(queries, bounds.tolist(), best, strict=True):
        open_nodes = [(-bound[0], 0)]
        while open_nodes:
            reach, node = heapq.heappop(open_nodes)
            if -reach < top.score:
                break
            if -reach == top.score and least[node] > top.least_id:
                continue
            left = child[node]
            if left < 0:
                rows = slice(start[node], stop[node])
                scores = points[rows] @ query
                top.add(np.clip(scores, *_LONG) if scores.dtype == object else scores, ids[rows])
            else:
                heapq.heappush(open_nodes, (-bound[left], left))
                heapq.heappush(open_nodes, (-bound[left + 1], left + 1))


def _part(vector: str, id: str) -> Column:
    """Rows that take part."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf"))

    return F.col(id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(vector, usable), F.lit(False))


def _numbers(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All components end to end as whole numbers, and the length of each vector."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    return values, np.diff(column.offsets.to_numpy())


def vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    typed = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return typed.filter(_part("vector", "vec_id"))


def trees(rows: DataFrame, shard_values: int = SHARD_VALUES, leaf: int = LEAF) -> DataFrame:
    """One row per shard: its number, the length of its vectors and the tree. Shards are cut where rows are read."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        first = TaskContext.get().partitionId() << 32
        made = 0

        def cut(dims: int, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            ids = np.concatenate([i for i, _ in held[dims]])
            points = np.concatenate([p for _, p in held[dims]])
            size = max(1, shard_values // max(1, dims))
            while len(ids) >= max(least, 1):
                tree = build(points[:size], ids[:size], leaf)
                ids, points = ids[size:], points[size:]
                row = [pa.array([first + made]), pa.array([dims], pa.int32()), pa.array([pickle.dumps(tree)])]
                yield pa.RecordBatch.from_arrays(row, ["shard", "dims", "tree"])
                made += 1
            held[dims] = [(ids, points)]

        for batch in batches(source):
            values, lengths = _numbers(batch.column(1))
            ids = batch.column(0).to_numpy()
            ends = np.cumsum(lengths)
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                points = values[(ends[at] - dims)[:, None] + np.arange(dims)]
                held.setdefault(dims, []).append((ids[at], points))
                if sum(len(i) for i, _ in held[dims]) * max(1, dims) >= shard_values:
                    yield from cut(dims, max(1, shard_values // max(1, dims)))
        for dims in list(held):
            yield from cut(dims, 1)

    return rows.mapInArrow(run, _TREES)


def _searched(rows: DataFrame, k: int, leaf: int) -> DataFrame:
    """Of rows sorted by lane, queries before trees: what each lane adds to the best k of each query."""

    def found(best: list[Best]) -> Iterator[pa.RecordBatch]:
        rows = [(b.own, i, -s) for b in best for s, i, fresh in b.rows if fresh]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["query_id", "vec_id", "score"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, by_dims, packed = None, {}, {}
        for batch in source:
            for i in range(batch.num_rows):
                at, dims = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if at != lane:
                    for best, _ in by_dims.values():
                        yield from found(best)
                    lane, by_dims, packed = at, {}, {}
                if (tree := batch.column(2)[i]).is_valid:
                    if dims in by_dims:
                        best, asked = by_dims[dims]
                        if dims not in packed:
                            packed[dims] = np.floor(np.array(asked, np.float64).reshape(len(asked), dims) * SCALE)
                        search(pickle.loads(tree.as_py()), packed[dims], best, leaf)
                else:
                    best, asked = by_dims.setdefault(dims, ([], []))
                    known = [(x["score"], x["vec_id"]) for x in batch.column(5)[i].as_py() or []]
                    best.append(Best(batch.column(3)[i].as_py(), k, known))
                    asked.append(batch.column(4).slice(i, 1).flatten().to_numpy(zero_copy_only=False))
        for best, _ in by_dims.values():
            yield from found(best)

    return rows.mapInArrow(run, _FOUND)


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query with their rank; Spark limits the ranks before the shuffle as well."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    df: DataFrame,
    queries: Callable[[Column], Column],
    k: int = K,
    id: str = "vec_id",
    vector: str = "embedding",
    shard_values: int = SHARD_VALUES,
    block_values: int = BLOCK_VALUES,
    leaf: int = LEAF,
    name: str = "topk",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows of ``df`` for each row whose id ``queries`` accepts."""
    rows = vectors(df, id, vector)
    index = stage(trees(rows, shard_values, leaf), f"{name}-trees")
    asked = rows.filter(queries(F.col("vec_id"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stage(asked.withColumn("dims", F.size("vector")), f"{name}-queries")
    shards = index.count()
    values = asked.agg(F.coalesce(F.sum(F.greatest("dims", F.lit(1))), F.lit(0))).first()[0]
    blocks = -(-values // block_values)
    lanes = max(1, shards // max(LANE_SHARDS, 2 * min(values, block_values) // shard_values))
    dealt = index.select(
        F.pmod(F.xxhash64("shard"), F.lit(lanes)).cast("int").alias("lane"),
        "dims",
        "tree",
        F.lit(None).cast("long").alias("vec_id"),
        F.lit(None).cast("array<double>").alias("vector"),
        F.lit(None).cast("array<struct<score:long,vec_id:long>>").alias("known"),
    )
    found = df.sparkSession.createDataFrame([], f"{_FOUND}, rank int")
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)) == block)
        best, begin, end = None, 0, 1
        while begin < lanes:
            carried = own.withColumn("known", F.lit(None).cast("array<struct<score:long,vec_id:long>>"))
            if best is not None:
                known = best.groupBy(F.col("query_id").alias("vec_id")).agg(
                    F.collect_list(F.struct("score", F.col("vec_id"))).alias("known")
                )
                carried = own.join(known, "vec_id", "left")
            home = F.pmod(F.xxhash64("vec_id"), F.lit(lanes))
            steps = F.explode(F.sequence(F.lit(begin), F.lit(min(end, lanes) - 1)))
            visits = carried.withColumn("_step", steps).select(
                F.pmod(home + F.col("_step"), F.lit(lanes)).cast("int").alias("lane"),
                "dims",
                F.lit(None).cast("binary").alias("tree"),
                "vec_id",
                "vector",
                "known",
            )
            both = dealt.unionByName(visits).repartition("lane")
            both = both.sortWithinPartitions("lane", F.col("tree").isNotNull())
            fresh = _searched(both, k, leaf)
            if best is not None:
                fresh = fresh.unionByName(best.drop("rank"))
            best = stage(_best(fresh, k), f"{name}-best")
            begin, end = end, end * GROWTH
        found = found.unionByName(best)
    return found.select("query_id", "rank", "vec_id", "score")
