"""Approximate nearest neighbours (operator 2): vantage-point trees per shard.

Cosine order is the order of distance between unit vectors, a metric. Each shard
of the rows has a tree: a node takes a vantage point, splits its rows at the
median distance from it, and ends in leaves of ``LEAF`` rows. A query goes to the
side it lies on first. The other side can hold nothing nearer than the gap
between the query and the median (triangle inequality), so it is skipped where
``factor * gap`` exceeds the distance of the query's worst kept neighbour. Factor
one is exact; a larger one skips more. Queries of a block go down together, so
that distances are products of matrices.

Kept rows are ranked by the cosine of the original vectors, in doubles.

Every row is in a tree, no tree is fitted on a sample, and trees are rebuilt with
every search: they are small, and a lost task only redoes its shard.

Defined cases: null and zero vectors and those with null or non-finite
components take no part, nor do null ids; a repeated id is one row, with its
smallest vector; copies of a vector are one row of a tree, and ties go to the
smaller id; vectors of different lengths are not compared; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._vectors import distinct_rows, search_blocks, usable

LEAF = 128
FACTOR = 4.0  # skips little of unclustered data; recall 1.0 there, see the README
SPARE = 8  # rows kept beyond k, for the query's own and for scores equal but for rounding


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of tiny or huge values stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class VPTree:
    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 1):
        self.points, self._leaf = points, leaf
        self._random = np.random.default_rng(seed)
        self.visited = 0  # distances computed, for measurements
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self._leaf:
            return rows
        # Of a few points, the one whose distances spread most splits best.
        tries = self._random.choice(rows, min(8, len(rows)), replace=False)
        d = self._distance(self.points[tries], rows)
        best = int(d.std(axis=1).argmax())
        middle = float(np.median(d[best]))
        near = d[best] <= middle
        if near.all():
            return rows
        return int(tries[best]), middle, self._build(rows[near]), self._build(rows[~near])

    def _distance(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (q @ self.points[rows].T), 0))

    def search(self, q: np.ndarray, k: int, factor: float) -> np.ndarray:
        """Rows of the k nearest points found for each query, -1 where fewer."""
        self._q, self._factor = q, factor
        self._far = np.full((len(q), k), np.inf)
        self._row = np.full((len(q), k), -1)
        self._visit(self.root, np.arange(len(q)))
        return self._row

    def _visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            d = self._distance(self._q[who], node)
            self.visited += d.size
            k = self._far.shape[1]
            all_d = np.concatenate([self._far[who], d], axis=1)
            all_r = np.concatenate([self._row[who], np.broadcast_to(node, d.shape)], axis=1)
            pick = np.argpartition(all_d, k - 1, axis=1)[:, :k]
            self._far[who] = np.take_along_axis(all_d, pick, 1)
            self._row[who] = np.take_along_axis(all_r, pick, 1)
            return
        vantage, middle, near, far = node
        d = self._distance(self._q[who], np.array([vantage]))[:, 0]
        self.visited += len(d)
        inside = d <= middle
        for first, second, side, gap in ((near, far, inside, middle - d), (far, near, ~inside, d - middle)):
            mine, g = who[side], gap[side]
            self._visit(first, mine)
            worst = self._far[mine].max(axis=1)
            self._visit(second, mine[self._factor * g <= worst + 1e-9])


def _search(k: int, factor: float):
    def search(ids, x, qids, q):
        rows, members = distinct_rows(ids, x)
        tree = VPTree(unit(rows))
        got = tree.search(unit(q), k + SPARE, factor)
        norms = np.sqrt((rows * rows).sum(axis=1))
        at, found, scores = [], [], []
        for i, c in enumerate(got):
            c = c[c >= 0]
            s = (rows[c] * q[i]).sum(axis=1) / (norms[c] * np.sqrt((q[i] * q[i]).sum()))
            cand = [(-v, m) for v, r in zip(s.tolist(), c, strict=True) for m in members[r][: k + 1].tolist() if m != qids[i]]
            cand.sort()
            for v, m in cand[:k]:
                at.append(i)
                found.append(m)
                scores.append(-v)
        return at, found, scores

    return search


def nearest_neighbours(vectors: DataFrame, query: Column, k: int = 5, factor: float = FACTOR, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found by cosine
    for each query (rows where ``query``, an expression of ``id``, holds), nearest
    first, ties to the smaller id. ``factor`` 1 finds them exactly."""
    vec = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(usable(vec) & F.exists(vec, lambda x: x != 0))
    return search_blocks(rows, query, k, "double", _search(k, factor))
