"""Connected components of an undirected edge table, by repeated contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import pinned


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any orderable type -> ``(node, label)``; the label is
    some node of the component, the same for all its nodes. Only nodes with an
    edge to another node appear.

    Each round sends every node to the first node within two steps of it, in an
    order drawn anew for the round (a hash), and replaces the edges by those
    between the images; edges inside one image go away. A star of any size is
    contracted at once, a chain to a fraction of its length, so rounds grow with
    the logarithm of the longest chain. Minima are taken with map-side
    combining, so a hub of any degree costs one row per task; nothing passes
    through the driver but whether edges are left."""
    both = edges.select("a", "b").where("a <> b")
    current = pinned(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = current.select(F.col("a").alias("node")).union(current.select("b")).distinct()
    steps: list[DataFrame] = []
    while current.take(1):
        turn = F.lit(len(steps))

        def drawn(c: str, turn=turn):
            return F.struct(F.xxhash64(F.col(c), turn).alias("h"), F.col(c).alias("v"))

        sym = current.union(current.select("b", "a"))
        one = sym.groupBy("a").agg(F.min(F.least(drawn("a"), drawn("b"))).alias("m"))
        reach = sym.join(one.select(F.col("a").alias("k"), "m"), F.col("b") == F.col("k"))
        image = pinned(reach.groupBy("a").agg(F.min("m").alias("m")).select("a", F.col("m.v").alias("to")))
        steps.append(image)
        left = image.select(F.col("a").alias("ka"), F.col("to").alias("ta"))
        right = image.select(F.col("a").alias("kb"), F.col("to").alias("tb"))
        moved = current.join(left, F.col("a") == F.col("ka")).join(right, F.col("b") == F.col("kb"))
        moved = moved.where("ta <> tb")
        current = pinned(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    start = nodes.select("node", F.col("node").alias("label"))

    def follow(labels: DataFrame, image: DataFrame) -> DataFrame:
        step = image.select(F.col("a").alias("__from"), F.col("to").alias("__to"))
        joined = labels.join(step, F.col("label") == F.col("__from"), "left")
        return joined.select("node", F.coalesce("__to", "label").alias("label"))

    return pinned(reduce(follow, steps, start))
