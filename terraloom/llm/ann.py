"""Approximate nearest neighbours by stable projections (operator 4).

Vectors are scaled to length 1, so that the largest cosine is the smallest distance, and projected by a Gaussian
matrix to a few dimensions. For a pair at distance d the squared projected distance is d^2 times a chi-square
variable. The projected points are indexed by a kd-tree: its upper levels, fitted on a bounded sample, deal all
vectors to shards; in each shard the tree goes on down to small leaves.

A query takes its projected neighbours one after the other and verifies their vectors exactly. It stops once a
chi-square test says that a vector nearer than the k-th best would have shown up by now with the wanted probability.
The first round searches the query's own shard; the k-th best found there tells by the same test which other shards
can matter, and only to these the query goes in the second round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release, shared_table, small_batches

#: Projected dimensions (even), points in a leaf, rows in a shard, and the stopping probability.
DIMS, LEAF, SHARD, SURE = 8, 32, 16_384, 0.95
#: Vectors of the sample on which the upper levels are fitted.
SAMPLE = 50_000
#: Leaves that are opened, and points that are verified, at once.
OPENED, VERIFIED = 8, 256
_SEED = 20_240_601


def chi_square_cdf(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function of the sum of ``dims`` (even) squared standard normals."""
    half, term, total = np.asarray(x) / 2, 1.0, 0.0
    for i in range(dims // 2):
        total = total + term
        term = term * half / (i + 1)
    return 1 - np.exp(-half) * total


def chi_square_bound(sure: float, dims: int) -> float:
    """The x at which the distribution function reaches ``sure``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < sure else (low, mid)
    return high


def project(vectors: np.ndarray, dims: int = DIMS) -> np.ndarray:
    matrix = np.random.default_rng(_SEED).standard_normal((vectors.shape[1], dims))
    return (vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]) @ matrix


class Cells:
    """The upper levels of a kd-tree: boxes of about equally many sample points that fill the projected space."""

    def __init__(self, points: np.ndarray, count: int):
        dims = points.shape[1]
        self.axis, self.at, self.kids, self.low, self.high = [], [], [], [], []
        todo = [(np.arange(len(points)), count, np.full(dims, -np.inf), np.full(dims, np.inf), None)]
        while todo:
            own, parts, low, high, parent = todo.pop()
            part = points[own]
            spread = np.ptp(part, axis=0) if len(own) else np.zeros(dims)
            axis = int(spread.argmax())
            if parts <= 1 or len(own) < 2 or not spread[axis]:
                self.low.append(low)
                self.high.append(high)
                node = -len(self.low)  # a leaf
            else:
                values = np.sort(part[:, axis])
                place = values[len(own) * (parts // 2) // parts]
                place = place if place > values[0] else values[values > values[0]][0]
                node = len(self.axis)
                self.axis.append(axis)
                self.at.append(place)
                self.kids.append([0, 0])
                below = part[:, axis] < place
                for side, mask, n in ((0, below, parts // 2), (1, ~below, parts - parts // 2)):
                    lo, hi = low.copy(), high.copy()
                    (hi if side == 0 else lo)[axis] = place
                    todo.append((own[mask], n, lo, hi, (node, side)))
            if parent is not None:
                self.kids[parent[0]][parent[1]] = node
        self.root = 0 if self.axis else -1
        self.axis, self.at, self.kids = np.array(self.axis, int), np.array(self.at, float), np.array(self.kids, int).reshape(-1, 2)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        node = np.full(len(points), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            node[inner] = self.kids[at, (points[inner, self.axis[at]] >= self.at[at]).astype(int)]
        return -node - 1

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance from q to each cell."""
        return (np.maximum(np.maximum(self.low - q, q - self.high), 0) ** 2).sum(axis=1)


class KdTree:
    """The lower levels: leaves of a kd-tree over projected points, split at the median of the widest dimension."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        todo, leaves = [np.arange(len(points))] if len(points) else [], []
        while todo:
            own = todo.pop()
            if len(own) <= leaf:
                leaves.append(own)
                continue
            part = points[own]
            order = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], len(own) // 2)
            todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
        self.points, self.leaves = points, leaves
        self.low = np.array([points[x].min(axis=0) for x in leaves])
        self.high = np.array([points[x].max(axis=0) for x in leaves])

    def incremental(self, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points in the order of their distance from q: (squared distances, rows), a few at a time."""
        near = (np.maximum(np.maximum(self.low - q, q - self.high), 0) ** 2).sum(axis=1)
        order = np.argsort(near, kind="stable")
        held_d, held = np.zeros(0), np.zeros(0, np.int64)
        for a in range(0, len(order), OPENED):
            rows = np.concatenate([self.leaves[j] for j in order[a : a + OPENED]])
            held_d, held = np.concatenate([held_d, ((self.points[rows] - q) ** 2).sum(axis=1)]), np.concatenate([held, rows])
            # What is nearer than all unopened leaves comes now.
            limit = near[order[a + OPENED]] if a + OPENED < len(order) else np.inf
            ready = held_d <= limit
            if ready.any():
                now_d, now = held_d[ready], held[ready]
                held_d, held = held_d[~ready], held[~ready]
                by = np.argsort(now_d, kind="stable")
                for b in range(0, len(by), VERIFIED):
                    part = by[b : b + VERIFIED]
                    yield now_d[part], now[part]


class Shard:
    """Vectors of one shard with their tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        _, first = np.unique(ids, return_index=True)
        self.ids, self.vectors = ids[first], vectors[first]
        self.length = np.sqrt((self.vectors**2).sum(axis=1))
        self.tree = KdTree(project(self.vectors))

    def search(self, q_id: int, q: np.ndarray, k: int, bound: float, known: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, cosines) of the k best other vectors, none worse than ``known``, the k-th best cosine of elsewhere;
        and how many were verified."""
        best_ids, best, verified = np.zeros(0, np.int64), np.zeros(0), 0
        q_length = np.sqrt((q**2).sum())
        for near, rows in self.tree.incremental(project(q[None])[0]):
            least = max(best[-1] if len(best) == k else -np.inf, known)
            far = bound * max(0.0, 2 - 2 * least) + 1e-9
            if near[0] > far:
                break
            rows = rows[(near <= far) & (self.ids[rows] != q_id)]
            verified += len(rows)
            cosine = self.vectors[rows] @ q / (self.length[rows] * q_length)
            hit = cosine >= least
            if hit.any():
                best_ids, best = np.concatenate([best_ids, self.ids[rows[hit]]]), np.concatenate([best, cosine[hit]])
                top = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[top], best[top]
        return best_ids, best, verified


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if len(column) else np.zeros((0, dim))


def _placed(rows: DataFrame, cells) -> DataFrame:
    """Adds each vector's cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                cell = cells.value[int(dim)].of(project(_matrix(part.column(1), int(dim))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32))], names=[*part.schema.names, "cell"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, dim int, cell int")


def _searched(data: DataFrame, asked: DataFrame, k: int, bound: float) -> DataFrame:
    """The best of each shard for the queries that were sent to it. Of a shard the vectors come first and make the
    tree, once; then its queries stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None
        for batch in batches:
            found = []
            dims, cell, sub, kind = (batch.column(c).to_numpy() for c in range(4))
            known = batch.column(6).to_numpy()
            edge = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1]) | (kind[1:] != kind[:-1])]).tolist() if len(dims) else []
            for a, b in zip(edge, [*edge[1:], len(dims)]):
                key = (dims[a], cell[a], sub[a])
                if key != now:
                    now, held, shard = key, [], None
                ids, vectors = batch.column(4).slice(a, b - a).to_numpy(), _matrix(batch.column(5).slice(a, b - a), int(dims[a]))
                if kind[a] == 0:
                    held.append((ids, vectors))
                    continue
                if shard is None and held:
                    shard = Shard(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                for j in range(len(ids) if shard else 0):
                    near, score, _ = shard.search(ids[j], vectors[j], k, bound, known[a + j])
                    found.append((np.full(len(near), ids[j]), near, score))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["query_id", "vec_id", "score"])
        release()

    names = ["dim", "cell", "sub", "kind", "vec_id", "v", "known"]
    both = data.withColumn("kind", F.lit(0)).withColumn("known", F.lit(0.0)).select(*names).union(asked.withColumn("kind", F.lit(1)).select(*names))
    keys = ["dim", "cell", "sub"]
    small_batches(data.sparkSession)
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, query_where, k: int = 5, sure: float = SURE, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD) -> DataFrame:
    """For each row that ``query_where`` (a condition on ``vec_id``) selects, its k nearest other rows by cosine.

    One row per query and rank: query_id, rank, vec_id, score. Every vector is indexed, in one shard. A cell with
    more rows than a shard may have (many equal vectors) is several shards by a hash of the id. Vectors that are null,
    empty or zero, or hold null or non-finite components, take no part, nor do null ids. Vectors of other lengths
    than the query's are no candidates. Repeated rows of an id count once. Ties go to the smaller id. Fewer than k
    candidates give fewer rows, an empty table none. Other columns are not read.
    """
    spark = vectors.sparkSession
    bound = chi_square_bound(sure, DIMS)
    e = F.col("v")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where("vec_id is not null and v is not null").where((F.size(e) > 0) & ~odd & F.exists("v", lambda x: x != 0))
        .withColumn("dim", F.size("v"))
    )
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # lengths of vectors: one, as a rule
    total = sum(counts.values())
    some = rows.where(F.xxhash64("vec_id") / 2.0**64 + 0.5 <= min(1.0, SAMPLE / max(total, 1)))
    cells = {}
    for dim, n in counts.items():
        sample = _matrix(some.where(F.col("dim") == dim).select("v").toArrow().column(0).combine_chunks(), dim) if n > shard_rows else np.zeros((0, dim))
        cells[dim] = Cells(project(sample) if len(sample) else np.zeros((0, DIMS)), math.ceil(n / shard_rows))
    shipped = spark.sparkContext.broadcast(cells)
    small_batches(spark)
    placed = shared_table(_placed(rows, shipped))
    sizes = placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / shard_rows).cast("int").alias("subs"))
    sizes = F.broadcast(cut(sizes))  # one row for each cell: at most the sample's size
    data = placed.join(sizes, ["dim", "cell"]).withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int"))
    queries = placed.where(query_where).dropDuplicates(["vec_id"])
    every = F.explode(F.sequence(F.lit(0), F.col("subs") - 1))

    own = queries.withColumn("known", F.lit(float("-inf"))).join(sizes, ["dim", "cell"]).withColumn("sub", every)
    first = cut(_searched(data, own, k, bound))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("known"))

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, there = [], []
            known = batch.column(4).to_pylist()
            for j, (dim, cell) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                point = project(_matrix(batch.column(1).slice(j, 1), dim))[0]
                least = -np.inf if known[j] is None else known[j]
                found = np.flatnonzero(shipped.value[dim].distances(point) <= bound * max(0.0, 2 - 2 * least) + 1e-9)
                found = found[found != cell]
                picked.append(np.full(len(found), j))
                there.append(found)
                if sum(map(len, picked)) >= 4096 or j == batch.num_rows - 1:
                    at = np.concatenate(picked)
                    values = [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), pa.array(np.concatenate(there).astype(np.int32)), pa.array([-np.inf if known[i] is None else known[i] for i in at], pa.float64())]
                    yield pa.RecordBatch.from_arrays(values, names=["vec_id", "v", "dim", "cell", "known"])
                    picked, there = [], []

    sent = queries.join(best, "vec_id", "left").select("vec_id", "v", "dim", "cell", "known").mapInArrow(further, "vec_id long, v array<double>, dim int, cell int, known double")
    second = _searched(data, sent.join(sizes, ["dim", "cell"]).withColumn("sub", every), k, bound)
    found = first.union(second)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
