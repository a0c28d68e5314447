"""Exact top-k search (operator 1): no-random-access aggregation.

A score is the sum over components of weight times value. Each shard holds, for
every component, the list of its rows sorted by value; a query reads the lists
of its positive weights from the top and those of its negative weights from the
bottom, a stretch at a time, and never looks a row up. After each stretch, every
row has

* a lower bound: what was read of it, plus the list's last value for what was
  not;
* an upper bound: what was read of it, plus the value the list has reached for
  what was not.

A row is an outsider for good once its upper bound is below the k-th best lower
bound. A query stops reading when no more than ``resolve`` rows are left, and
their final scores are resolved exactly. With all lists read the bounds are the
scores, so the answer is exact in any case. The bounds of all rows and of a
block of queries are kept together, as sums of products of matrices.

Values are whole numbers, floor(scale * x), and scores are exact: in doubles
while all sums stay below 2**53, beyond that in unbounded integers (clipped to
the range of a long in the result).

Defined cases: null vectors and those with null or non-finite components take no
part, nor do null ids; a repeated id is one row, with its smallest vector; copies
of a vector are one row of the lists, and ties go to the smaller id; vectors of
different lengths are not compared; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._vectors import distinct_rows, search_blocks, usable

STRETCHES = (1 / 2, 3 / 4, 7 / 8, 1)  # depths, as shares of the lists
RESOLVE = 512


def nra_block(x: np.ndarray, q: np.ndarray, k: int, barred: np.ndarray, resolve: int = RESOLVE, depths: tuple[float, ...] = STRETCHES) -> list[np.ndarray]:
    """Rows of ``x`` that can be among the ``k`` best for each query; ``barred``
    is the row a query may not use, or -1."""
    n, d = x.shape
    k = min(k, n)
    weights = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)  # read from the top; from the bottom
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.concatenate([order[::-1], order], axis=1)  # rows of every list, in reading order
    values = np.take_along_axis(np.concatenate([x, x], axis=1), lists, 0)
    last = values[-1]
    over_last, over_here = np.zeros((n, 2 * d), x.dtype), np.zeros((n, 2 * d), x.dtype)
    cols = np.arange(2 * d)[None]
    out: list[np.ndarray | None] = [None] * len(q)
    open_, done = np.arange(len(q)), 0
    for share in depths:
        to = min(n, max(done + 1, int(np.ceil(n * share))))
        # What was read, above the value each list ends with, and above the one it has reached.
        over_last[lists[done:to], cols] = values[done:to] - last
        over_here[lists[:to], cols] = values[:to] - values[to - 1]
        done = to
        w = weights[open_]
        least = w @ over_last.T + (w @ last)[:, None]
        most = w @ over_here.T + (w @ values[to - 1])[:, None]
        own = barred[open_]
        has = np.flatnonzero(own >= 0)
        least[has, own[has]] = most[has, own[has]] = -np.inf
        kth = np.partition(least, n - k, axis=1)[:, n - k]
        left = most >= np.maximum(kth, np.finfo(x.dtype).min)[:, None]
        stop = (left.sum(axis=1) <= resolve) | (to == n)
        for i in np.flatnonzero(stop):
            out[open_[i]] = np.flatnonzero(left[i])
        open_ = open_[~stop]
        if not len(open_):
            break
    return out


def _search(k: int, scale: int):
    def search(ids, x, qids, q):
        x, q = np.floor(scale * x), np.floor(scale * q)
        rows, members = distinct_rows(ids, x)
        most = 4 * np.abs(rows).max() * np.abs(q).max() * x.shape[1]  # bounds all sums of a search
        where = {int(m[0]): i for i, m in enumerate(members) if len(m) == 1}
        barred = np.array([where.get(int(i), -1) for i in qids])
        if most < 2.0**53:
            small = np.float32 if most < 2.0**24 else np.float64
            left = nra_block(rows.astype(small), q.astype(small), k, barred)
        else:  # doubles would round the bounds
            left = [np.setdiff1d(np.arange(len(rows)), [b]) for b in barred]
            rows, q = rows.astype(object), q.astype(object)
            for a in (rows, q):
                a[:] = [[int(v) for v in r] for r in a]
        at, found, scores = [], [], []
        for i, c in enumerate(left):
            s = rows[c] @ q[i]
            cand = [(-v, m) for v, r in zip(s.tolist(), c, strict=True) for m in members[r][: k + 1].tolist() if m != qids[i]]
            cand.sort()
            for v, m in cand[:k]:
                at.append(i)
                found.append(m)
                scores.append(max(-(2**63), min(2**63 - 1, int(-v))))
        return at, found, scores

    return search


def exact_topk(vectors: DataFrame, query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of
    each query (rows where ``query``, an expression of ``id``, holds) with all
    other rows; ties to the smaller id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(usable(F.col("vec")))
    return search_blocks(rows, query, k, "long", _search(k, scale))
