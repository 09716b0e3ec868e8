"""Approximate nearest neighbours by largest inner product: vantage-point trees per shard.

Vectors get one more component, so that all have the greatest length found; queries get a
zero there. The Euclidean distance of such a query and vector then falls as their inner
product grows, and it is a metric: it obeys the triangle inequality, which inner products
do not.

Rows are dealt over shards of about ``SHARD`` rows by a hash, so no label or cluster, however
hot, makes a large one. A task builds the tree of each of its shards: a node's points are
ordered by their distance to a vantage point and cut in the middle, and both halves keep
the range of these distances, until ``LEAF`` points are left. Queries arrive at every
shard and go through the tree together. Each first goes down to the leaf where it would
stand itself, which gives a first kth best distance; then the tree is walked once, and a
half is left out for a query where

    factor * (gap between its distance to the vantage point and the half's range)

exceeds the kth best distance so far. The gap is the least distance that the triangle
inequality allows, so ``factor`` 1 leaves nothing out that could count: exact search.
Larger factors trust a multiple of the gap. Scores are inner products of the original
vectors in double precision, added from the first component to the last.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexrarity.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a shard, and points of a leaf, about.
SHARD = 8192
LEAF = 128
#: Vantage points tried for a node, and points they are judged by.
TRIED, JUDGED = 8, 64
#: Queries that go through a tree together.
TOGETHER = 1024
#: Recall of 0.99 and more on the given vectors; 1 is exact.
FACTOR = 4.0
#: In place of a query's number, which tells its vector from others of its id.
POINT = -(1 << 63)
#: Error of a product of matrices, relative to the lengths of its vectors.
SLACK = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no NULL, NaN or infinity in it, and not zero."""
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from the first component to the last."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


class Tree:
    """The tree of one shard. Nodes stand before what is below them; ``skip`` is the first
    node behind a node's own part of the tree."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, longest: float):
        self.ids, self.points = ids, points
        short = np.sqrt(np.maximum(longest**2 - (points * points).sum(axis=1), 0))
        self.raised = np.concatenate([points, short[:, None]], axis=1)
        self.squares = (self.raised * self.raised).sum(axis=1)
        #: Of a node: vantage point or -1, ranges of both halves, its points if a leaf, skip.
        self.vantage, self.ranges, self.leaf, self.skip = [], [], [], []
        self.random = np.random.default_rng(len(ids))
        self._grow(np.arange(len(ids)))

    def _distances(self, one: int, many: np.ndarray) -> np.ndarray:
        apart = self.raised[many] - self.raised[one]
        return np.sqrt((apart * apart).sum(axis=1))

    def _grow(self, own: np.ndarray) -> None:
        at = len(self.vantage)
        self.vantage.append(-1)
        self.ranges.append(None)
        self.leaf.append(own)
        self.skip.append(at + 1)
        if len(own) <= LEAF:
            return
        judges = self.random.choice(own, min(JUDGED, len(own)), replace=False)
        tried = self.random.choice(own, min(TRIED, len(own)), replace=False)
        best = max(tried, key=lambda v: self._distances(v, judges).std())
        far = self._distances(best, own)
        order = np.argsort(far, kind="stable")
        near, away = order[: len(own) // 2], order[len(own) // 2 :]
        self.vantage[at], self.leaf[at] = int(best), None
        self.ranges[at] = tuple((far[half[0]], far[half[-1]]) for half in (near, away))
        self._grow(own[near])
        self._grow(own[away])
        self.skip[at] = len(self.vantage)

    def search(self, queries: np.ndarray, own_ids: np.ndarray, k: int, factor: float):
        """(query number, point, score) of each query's ``k`` best points found, without
        those that have its own id. Ties at the end of the list stay."""
        lengths = np.sqrt((queries * queries).sum(axis=1))
        raised = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        best = np.full((len(queries), k), -np.inf)  # scores, about
        slack = SLACK * lengths * np.sqrt(self.squares.max())
        found: list = [[], [], []]
        reach = np.full(len(queries), np.inf)  # distance of the kth best

        def visit(leaf: np.ndarray, active: np.ndarray) -> None:
            scores = queries[active] @ self.points[leaf].T
            scores[own_ids[active][:, None] == self.ids[leaf]] = -np.inf
            low = best[active].min(axis=1) - slack[active]
            query, point = np.nonzero((scores >= low[:, None]) & (scores > -np.inf))
            if not len(query):
                return
            found[0].append(active[query])
            found[1].append(leaf[point])
            found[2].append(scores[query, point])
            better = np.unique(query)
            both = np.concatenate([best[active[better]], scores[better]], axis=1)
            best[active[better]] = -np.partition(-both, k - 1, axis=1)[:, :k]
            kth = best[active[better]].min(axis=1)
            apart = lengths[active[better]] ** 2 + self.squares[leaf[0]] - 2 * kth
            reach[active[better]] = np.sqrt(np.maximum(apart, 0))

        def gap_of(active: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
            v = self.vantage[at]
            apart = lengths[active] ** 2 + self.squares[v] - 2 * (raised[active] @ self.raised[v])
            far = np.sqrt(np.maximum(apart, 0))
            return tuple(np.maximum(np.maximum(low - far, far - high), 0) for low, high in self.ranges[at])

        home = np.zeros(len(queries), int)
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            at, active = waiting.pop()
            if self.vantage[at] < 0:
                home[active] = at
                visit(self.leaf[at], active)
                continue
            near, away = gap_of(active, at)
            first = near <= away
            halves = ((at + 1, active[first]), (self.skip[at + 1], active[~first]))
            waiting += [half for half in halves if len(half[1])]
        waiting = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while waiting:
            at, active, gap = waiting.pop()
            # The kth best may have come nearer since this half was put aside.
            active = active[factor * gap <= reach[active] * (1 + SLACK) + SLACK]
            if not len(active):
                continue
            if self.vantage[at] < 0:
                visit(self.leaf[at], active[home[active] != at])
                continue
            near, away = gap_of(active, at)
            waiting += [(self.skip[at + 1], active, away), (at + 1, active, near)]
        if not found[0]:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        query, point, about = map(np.concatenate, found)
        kept = about >= best[query].min(axis=1) - slack[query]
        query, point = query[kept], point[kept]
        score = np.concatenate([
            in_order(queries[query[k : k + 65536]], self.points[point[k : k + 65536]])
            for k in range(0, len(query), 65536)]) if len(query) else np.zeros(0)
        order = np.lexsort((self.ids[point], -score, query))
        query, point, score = query[order], point[order], score[order]
        start = np.searchsorted(query, query, side="left")
        kept = np.arange(len(query)) - start < k
        return query[kept], point[kept], score[kept]


def _searched(k: int, factor: float, longest: float):
    """Rows come shard by shard, a shard's points before its queries."""

    def run(batches):
        shard, tree = None, None
        ids: list = []
        points: list = []
        for batch in batches:
            shards = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy()
            own = batch.column(2).to_numpy()
            vector = batch.column(3)
            flat = vector.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(vector.value_lengths().to_numpy())
            cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(asks == POINT) != 0)) + 1
            for rows in np.split(np.arange(batch.num_rows), cuts):
                if not len(rows):
                    continue
                if shards[rows[0]] != shard:
                    shard, tree, ids, points = shards[rows[0]], None, [], []
                first = ends[rows[0] - 1] if rows[0] else 0
                vectors = flat[first : ends[rows[-1]]].reshape(len(rows), -1)
                if asks[rows[0]] == POINT:
                    ids.append(own[rows])
                    points.append(vectors)
                    continue
                if not ids:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(ids), np.concatenate(points), longest)
                for low in range(0, len(rows), TOGETHER):
                    some = slice(low, low + TOGETHER)
                    query, point, score = tree.search(vectors[some], own[rows][some], k, factor)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[rows][some][query]), pa.array(asks[rows][some][query]),
                         pa.array(tree.ids[point]), pa.array(score)],
                        names=["query_id", "asks", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, factor: float = FACTOR, shard: int = SHARD,
            id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row of ``queries`` the
    ``k`` rows of ``vectors`` with the largest inner products found, all with ``factor`` 1;
    ties by the smaller id; fewer rows if there are fewer.

    Rows with the query's own id are not its candidates. A repeated row of ``vectors`` is
    a candidate each time; a query with repeated rows is answered once for each of its
    distinct vectors. Vectors that are NULL, empty, zero or hold NULL, NaN or infinity, and
    rows without id, take no part. Only vectors with as many components as the query are
    its candidates. An empty table gives an empty one. Other columns do not count.
    """
    def parts(df: DataFrame) -> DataFrame:
        vector = F.col(vector_column).cast("array<double>")
        return df.where(F.col(id_column).isNotNull() & usable(vector)).select(
            F.col(id_column).cast("long").alias("id"), vector.alias("vector"), F.size(vector).alias("width"))

    points = stored(parts(vectors).select(
        "*", F.xxhash64("id", "vector", F.monotonically_increasing_id()).alias("_dealt")))
    asked = stored(parts(queries).distinct())
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    widths = stored(points.groupBy("width").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard)).cast("long").alias("shards"),
        F.max(length).alias("longest")))
    total, longest = widths.agg(F.sum("shards"), F.max("longest")).first()
    at = F.shiftleft(F.col("width").cast("long"), 32)
    dealt = points.join(widths, "width").select(
        (at + F.pmod("_dealt", "shards")).alias("shard"), F.lit(POINT).alias("asks"), "id", "vector")
    numbered = asked.withColumn("asks", F.shiftrightunsigned(F.xxhash64("vector"), 1))
    everywhere = numbered.join(widths, "width").select(
        F.explode(F.sequence(at, at + F.col("shards") - 1)).alias("shard"), "asks", "id", "vector")
    found = (
        dealt.unionByName(everywhere).repartition(2 * (total or 1), "shard")
        .sortWithinPartitions("shard", "asks").mapInArrow(
            _searched(k, factor, (longest or 0.0) * (1 + 1e-9)),
            "query_id long, asks long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "asks").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
