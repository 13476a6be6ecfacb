"""Approximate nearest neighbours with stable projections and kd-trees (operator 9).

Largest inner product becomes nearest Euclidean distance by one more component:
a row x gets sqrt(M^2 - |x|^2) (M: the largest norm), a query 0.  Random normal
(2-stable) projections to ``PROJECTED`` dimensions follow: the squared projected
distance of two vectors, over their squared distance, is chi-square distributed
with that many degrees of freedom.

Rows are dealt out to tasks, each of which indexes its rows by a kd-tree over
the projections.  A query visits the leaves in order of their projected
distance, in rounds of growing length, and verifies the rows with exact inner
products, until the next leaf is so far that, by the chi-square test, a row beyond it that is nearer than the
query's present k-th neighbour would have shown a smaller projected distance
with probability ``CERTAINTY``.  The k best of every task are merged.

Every row is indexed; queries are those stated, in blocks against all rows.

Defined results: vectors that are null, empty, zero, hold null or non-finite
components, or differ in length from most vectors take no part; equal scores go
to the smaller id; with fewer candidates than k all are returned; rows that
repeat an id other than the query's own are neighbours each; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import stored

PROJECTED = 12
CERTAINTY = 0.9
LEAF = 64
BLOCK_ROWS = 8_192          # rows indexed together
BLOCK_QUERIES = 1_024       # queries that travel together
FIRST_LEAVES, GROWTH = 4, 4  # leaves a query verifies in its first round, and how that number grows
SEED = 77


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees, by bisection on its closed form."""
    import math

    def below(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return low


class KdTree:
    """Leaves of nearly equal size over points, split at the median of the widest dimension, with bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        todo, self.bounds = [(0, len(points))], []
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                self.bounds.append((a, b))
                continue
            part = self.order[a:b]
            dim = int(np.ptp(points[part], axis=0).argmax())
            mid = (b - a) // 2
            self.order[a:b] = part[np.argpartition(points[part, dim], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.bounds.sort()
        self.low = np.array([points[self.order[a:b]].min(axis=0) for a, b in self.bounds])
        self.high = np.array([points[self.order[a:b]].max(axis=0) for a, b in self.bounds])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of every query to every leaf's box."""
        out = np.zeros((len(q), len(self.bounds)))
        for d in range(q.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, d] - q[:, d, None], q[:, d, None] - self.high[:, d]), 0)
            out += gap * gap
        return out


def projection(dimensions: int, projected: int = PROJECTED, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimensions + 1, projected))


class BlockIndex:
    """A task's rows, their projections and tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, basis: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by], vectors[by]
        self.square = largest * largest
        rest = np.sqrt(np.maximum(self.square - np.einsum("ij,ij->i", self.vectors, self.vectors), 0))
        self.basis = basis
        self.tree = KdTree(np.hstack([self.vectors, rest[:, None]]) @ basis)

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int, limit: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(query id, ids, scores)`` of each query's best rows of this block.

        Queries advance together: in each round the open ones verify their next leaves, one matrix product a leaf,
        and those that pass the test close.  The best are scored again pair by pair, so that equal vectors tie exactly.
        """
        near = self.tree.distances(queries @ self.basis[:-1])
        visit = np.argsort(near, axis=1, kind="stable")
        norms = np.einsum("ij,ij->i", queries, queries)
        scores = np.full((len(queries), len(self.ids)), -np.inf)
        own = np.searchsorted(self.ids, qids, "left"), np.searchsorted(self.ids, qids, "right")
        worst = np.full(len(queries), -np.inf)          # score of the present k-th neighbour
        is_open, at, step = np.arange(len(queries)), 0, FIRST_LEAVES
        while len(is_open):
            leaves = visit[is_open, at:at + step]
            by_leaf = np.argsort(leaves, axis=None, kind="stable")
            starts = np.searchsorted(leaves.ravel()[by_leaf], np.arange(len(self.tree.bounds) + 1))
            for leaf, (a, b) in enumerate(self.tree.bounds):
                asking = is_open[by_leaf[starts[leaf]:starts[leaf + 1]] // leaves.shape[1]]
                if len(asking):
                    rows = self.tree.order[a:b]
                    scores[np.ix_(asking, rows)] = queries[asking] @ self.vectors[rows].T
            for i in is_open:
                scores[i, own[0][i]:own[1][i]] = -np.inf
            if k <= scores.shape[1]:
                worst[is_open] = np.partition(scores[is_open], -k, axis=1)[:, -k]
            at += step
            step *= GROWTH
            if at >= visit.shape[1]:
                break
            distance = np.maximum(norms[is_open] + self.square - 2 * worst[is_open], 0.0)
            is_open = is_open[near[is_open, visit[is_open, at]] <= limit * distance]
        slack = 1e-12 * np.sqrt(norms * self.square)    # above the rounding of the matrix product
        for i, q in enumerate(queries):
            rows = np.flatnonzero((scores[i] >= worst[i] - slack[i]) & (scores[i] > -np.inf))
            exact = np.einsum("ij,j->i", self.vectors[rows], q)
            best = np.lexsort((self.ids[rows], -exact))[:k]
            yield int(qids[i]), self.ids[rows[best]], exact[best]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` of the vectors that take part, as doubles; all have the most frequent length."""
    v = F.col(vector).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(fine).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


def nearest(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 20, projected: int = PROJECTED,
            certainty: float = CERTAINTY, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` rows of ``df`` with the largest inner product, per row of ``queries``."""
    rows, asked = usable(df, key, vector), usable(queries, key, vector)
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    stats = rows.agg(F.max(square).alias("s"), F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    schema = "query_id bigint, id bigint, score double"
    if not stats["n"]:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    largest, basis = float(stats["s"]) ** 0.5 * (1 + 1e-12), projection(stats["d"], projected, seed)
    limit = chi_square_quantile(certainty, projected)
    blocks = max(1, -(-stats["n"] // BLOCK_ROWS))
    asked_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def pack(column: str, count: int):
        """Rows of a block as one row with packed ids and vectors (bounded by the block size)."""
        def work(keyed: tuple, pdf):
            import pandas as pd

            return pd.DataFrame({column: [keyed[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                                 "vs": [np.stack(pdf["v"].to_numpy()).astype(np.float64).tobytes()]})
        return work, f"{column} bigint, ids binary, vs binary"

    def packed(frame: DataFrame, column: str, count: int) -> DataFrame:
        work, out = pack(column, count)
        return frame.withColumn(column, F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count))).groupBy(column).applyInPandas(work, out)

    q = packed(asked, "qb", asked_blocks).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("rb"), "qb", "ids", "vs")
    r = packed(rows, "rb", blocks)

    def search(keyed: tuple, left, right):
        import pandas as pd

        found = []
        if len(left) and len(right):
            ids = np.frombuffer(left["ids"].iloc[0], np.int64)
            index = BlockIndex(ids, np.frombuffer(left["vs"].iloc[0]).reshape(len(ids), -1), largest, basis)
            for a, b in zip(right["ids"], right["vs"]):
                qids = np.frombuffer(a, np.int64)
                for qid, got, score in index.search(qids, np.frombuffer(b).reshape(len(qids), -1), k, limit):
                    found.append(pd.DataFrame({"query_id": qid, "id": got, "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "score": []})

    local = stored(r.groupBy("rb").cogroup(q.groupBy("rb")).applyInPandas(search, schema), "neighbours")
    # k best of all blocks, per query: a bounded heap would need a sort of blocks x k rows per query
    top = local.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k).alias("x"))
    return top.select("query_id", F.posexplode("x").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"))
