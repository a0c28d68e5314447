"""What both vector searches share: the query set against all rows, in blocks.

Vectors are dealt to shards by a hash of their id, queries to blocks; each pair
of shard and block is one task's work of bounded size, whatever the table's, and
returns the k best of the shard for each query. These are merged by a ranking
that Spark limits before it shuffles."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, BLOCK_ROWS = 8192, 1024


def usable(vec: Column) -> Column:
    """Neither null nor empty, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite, F.lit(False))


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors as doubles) of a table (id, vec) of equally long vectors,
    one row an id: the smallest vector of a repeated id."""
    ids = table.column("id").to_numpy()
    vecs = table.column("vec").combine_chunks()
    flat = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(ids), -1)
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    first = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
    return ids[first], x[first]


def distinct_rows(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, and the ascending ids of each. Copies of one vector are
    one row of an index, however many there are."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    new = np.r_[True, (x[1:] != x[:-1]).any(axis=1)]
    heads = np.flatnonzero(new)
    return x[heads], np.split(ids, heads[1:])


def search_blocks(rows: DataFrame, query: Column, k: int, score_type: str, search: Callable) -> DataFrame:
    """``rows(id, vec)`` -> ``(query_id, rank, vec_id, score)``. ``search(ids, x,
    query ids, queries)`` returns (query positions, ids, scores) of at least the
    k best of a shard for each query, its own id left out. Vectors of different
    lengths are not compared."""
    rows = rows.where(F.col("id").isNotNull()).withColumn("dim", F.size("vec"))
    queries = rows.where(query).groupBy("id", "dim").agg(F.min("vec").alias("vec"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(query).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // SHARD_ROWS)), max(1, -(-counts["q"] // BLOCK_ROWS))
    left = rows.select("id", "vec", "dim", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    right = queries.select("id", "vec", "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"))
    numbers = pa.float64() if score_type == "double" else pa.int64()

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            ids, x = matrix(a)
            qids, q = matrix(b)
            at, found, scores = search(ids, x, qids, q)
            at = qids[at]
        else:
            at, found, scores = [], [], []
        return pa.table([pa.array(at, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, numbers)], names=["query_id", "vec_id", "score"])

    keys = ["shard", "block", "dim"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
