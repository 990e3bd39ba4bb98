"""Nearest neighbours by stable projections: a kd-tree over a few projected coordinates is
read outwards from the query, and each candidate met is verified on the original vectors
until a chi-square test says that nothing nearer is likely to follow.

Largest inner products become smallest distances by one more coordinate: a vector x gets
``sqrt(M^2 - |x|^2)`` with M the greatest norm, a query 0. A Gaussian projection to ``m``
coordinates turns a distance d into one whose square over d^2 is chi-square with m degrees
of freedom. With the k-th best distance d found so far and the tree's next leaf at projected
distance r, a vector nearer than d still unread would have to be projected to r or beyond,
which has probability 1 - F(r^2 / d^2); the search ends when that falls below ``miss``.

Vectors are dealt into shards by a hash of their id and queries into blocks; each (shard,
block) is one task's work of bounded size, and every query meets every shard. Within a
shard equal vectors are one point with a list of ids, so copies neither crowd the tree nor
lose ties. No candidate is capped: the test alone ends a search.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components take no part. Repeated vec_ids are separate candidates; a query id is searched
once, with the first of its vectors in component order, and never finds rows of its own
id. Scores are sums of products in double precision, in component order. Other columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

K = 20
DIMENSIONS = 16  # projected coordinates; even, as the chi-square sum below asks for it
MISS = 0.02  # probability to miss a neighbour that the stopping test accepts
LEAF = 64
SHARD_ROWS, MIN_SHARDS, BLOCK_ROWS = 32_768, 16, 8_192
SEED = 20


def chi_square(x: np.ndarray | float, m: int):
    """Distribution function with an even number of degrees of freedom."""
    half = np.asarray(x) / 2
    term = total = np.ones_like(half)
    for j in range(1, m // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(m: int, miss: float) -> float:
    """The ratio of squared distances from which the stopping test holds."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < 1 - miss else (low, mid)
    return high


class Tree:
    """A balanced kd-tree: leaves of points, each with the box around them."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        bounds, todo = [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                bounds.append((a, b))
                continue
            own = points[self.order[a:b]]
            axis, mid = int(np.argmax(np.ptp(own, axis=0))), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        bounds.sort()
        self.starts = np.array([a for a, _ in bounds])
        self.ends = np.array([b for _, b in bounds])
        sorted_points = points[self.order]
        self.low = np.minimum.reduceat(sorted_points, self.starts, axis=0)
        self.high = np.maximum.reduceat(sorted_points, self.starts, axis=0)

    def frontier(self, query: np.ndarray) -> np.ndarray:
        """Squared distance from a projected query to every leaf's box."""
        out = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        return np.einsum("ij,ij->i", out, out)


class Shard:
    """Points of one shard, copies together, with their tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, greatest: float,
                 m: int = DIMENSIONS, miss: float = MISS, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        rows = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))
        _, first, same = np.unique(rows.ravel(), return_index=True, return_inverse=True)
        by_point = np.argsort(same, kind="stable")
        points = vectors[first].astype(np.float64)
        extra = np.sqrt(np.maximum(greatest ** 2 - np.einsum("ij,ij->i", points, points), 0))
        self.greatest = greatest
        self.axes = np.random.default_rng(SEED).standard_normal((points.shape[1] + 1, m))
        self.tree = Tree(np.column_stack([points, extra]) @ self.axes, leaf)
        self.points = points[self.tree.order]  # leaves lie one after the other
        starts = np.searchsorted(same[by_point], np.arange(len(first)))
        ends = np.append(starts[1:], len(ids))
        self.ids = [ids[by_point[starts[p]:ends[p]]] for p in self.tree.order]  # each sorted
        self.first_id = np.array([x[0] for x in self.ids])
        self.last_id = np.array([x[-1] for x in self.ids])
        self.ratio = stop_ratio(m, miss)

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, float]]:
        """(id, score) of up to ``k`` nearest rows of other ids, ties by smaller id."""
        frontier = self.tree.frontier(np.append(query, 0.0) @ self.axes)
        leaves = np.argsort(frontier, kind="stable")
        # one more than needed; points with nothing but the query's own id do not count
        want, done, step = k + 1, 0, 4
        found: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        best = np.empty(0)
        norm = float(query @ query) + self.greatest ** 2
        while done < len(leaves):
            if len(best) >= want:
                distance = max(norm - 2 * best[-want:].min(), 0.0)
                if frontier[leaves[done]] > self.ratio * distance:
                    break
            batch = leaves[done:done + step]
            at = np.concatenate([np.arange(self.tree.starts[x], self.tree.ends[x]) for x in batch])
            at = at[(self.first_id[at] != query_id) | (self.last_id[at] != query_id)]
            found.append(at)
            scores.append(self.points[at] @ query)
            best = np.concatenate([best, scores[-1]])
            if len(best) > want:
                best = np.partition(best, len(best) - want)[-want:]
            done, step = done + step, step * 2
        if not found:
            return []
        at, score = np.concatenate(found), np.concatenate(scores)
        if len(score) > want:
            # rounding may differ in the last digits here, hence the margin
            least = np.partition(score, len(score) - want)[-want]
            at = at[score >= least - 1e-9 * max(1.0, norm)]
        exact = np.cumsum(self.points[at] * query, axis=1)[:, -1]
        rows = [(-s, int(i)) for p, s in zip(at, exact.tolist())
                for i in self._others(p, query_id, k)]
        return [(i, -s) for s, i in sorted(rows)[:k]]

    def _others(self, p: int, query_id: int, k: int) -> np.ndarray:
        """The ``k`` smallest ids at a point, without the query's own."""
        ids = self.ids[p]
        if not self.first_id[p] <= query_id <= self.last_id[p]:
            return ids[:k]
        a, b = np.searchsorted(ids, query_id, "left"), np.searchsorted(ids, query_id, "right")
        return np.concatenate([ids[:a][:k], ids[b:b + k]])[:k]


def usable(vector: Column) -> Column:
    values = vector.cast("array<double>")
    return F.coalesce(
        vector.isNotNull() & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x)
                                      & (F.abs(x) != float("inf")))
        & F.exists(values, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, k: int = K, id: str = "vec_id",
           vector: str = "embedding", m: int = DIMENSIONS, miss: float = MISS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row that
    ``queries`` names."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asked"))
    rows = stored(rows.filter(usable(F.col("v")) & F.col("vec_id").isNotNull())
                  .withColumn("dim", F.size("v")), "vectors")
    sizes = (rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked"),
        F.max(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0),
                          lambda a, x: a + x * x)).alias("square"))
        .orderBy(F.desc("n"), "dim").first())
    if sizes is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.col("dim") == sizes["dim"])
    shards = max(MIN_SHARDS, math.ceil(sizes["n"] / SHARD_ROWS))
    blocks = max(1, math.ceil(sizes["asked"] / BLOCK_ROWS))
    greatest = math.sqrt(sizes["square"])

    points = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    asked = (rows.filter("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
             .select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
                     F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                     "vec_id", "v"))

    def run(data: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(data) and len(wanted):
            shard = Shard(data["vec_id"].to_numpy(), np.stack(data["v"].to_numpy()), greatest,
                          m, miss)
            for q, v in zip(wanted["vec_id"].tolist(), wanted["v"]):
                out += [(q, i, s) for i, s in shard.search(q, np.asarray(v, np.float64), k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (points.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInPandas(run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
