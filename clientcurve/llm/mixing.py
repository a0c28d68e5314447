"""Mixing sources to target weights (operator 8), with DataFrame functions only.

Every source gets a target number of words: its weight's share of ``share``
times all words, at most ``max_repeat`` times its own size, the excess of
capped sources reshared by weight (water filling: ``min(cap, level * weight)``).

A source of size S and target t takes each document ``floor(t / S)`` times, and
once more if the document's hash lies below the source's threshold. Thresholds
come from nested histograms: words are summed by (source, first 12 bits of the
hash), the bucket in which the running sum crosses the budget is found, and only
the documents of that bucket are histogrammed on the next 12 bits, down to 48
bits. No document is sorted; a histogram has at most 4,096 buckets a source and
a hot source is pre-aggregated in every task. The document at the threshold is
taken if that brings the source nearer to its target; of rows that share its hash, as
many as bring it nearest. Only these are numbered, by their place in the parts of the
table that they stand in: within a part by a window, over the parts by a running
count of one row a part.

The hash is the MD5 of id and text, so reruns agree, whatever the partitioning.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; a null id is hashed as ``null``. Rows equal in id and text share
one hash, and the threshold can fall among them. A source without words has target 0.
An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch, pinned, stored

LEVEL_BITS, LEVELS = 12, 4


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_key(doc_id: Column, text: Column) -> Column:
    """48 bits of MD5 over id and text."""
    whole = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(whole, 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeat: int) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``; weights go to
    the sources by code point, null last, and repeat. The windows run over one
    row a source."""
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = totals.withColumn("rank", F.row_number().over(by_name))
    ranked = ranked.withColumn("weight", F.get(cycle, (F.col("rank") - 1) % len(weights)))
    ranked = ranked.withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "rank")
    filled = ranked.select(
        "source", "source_size", "weight", "cap", "ratio",
        (F.sum("source_size").over(everything) * share).alias("budget"),
        F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)).alias("cap_to"),
        F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("weight_from"),
    )
    level = filled.withColumn("level", (F.col("budget") - (F.col("cap_to") - F.col("cap"))) / F.col("weight_from"))
    level = level.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    return level.select(
        "source", "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"),
    )


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source, whole copies of every document, and the hash up to which
    documents are taken once more (itself included or not)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("copies", whole).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = state
    state = state.where("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("below"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        s = state.select(F.col("source").alias("s"), "rest", "bucket", "below")
        inside = rows.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("key", shift + LEVEL_BITS) == F.col("bucket")))
        hist = inside.groupBy("source", "rest", "below", F.shiftright("key", shift).alias("b")).agg(F.sum("size").cast("long").alias("words"), F.count("*").alias("rows"))
        upto = Window.partitionBy("source").orderBy("b")
        run = hist.withColumn("upto", F.col("below") + F.sum("words").over(upto))
        at = F.min(F.struct("b", (F.col("upto") - F.col("words")).alias("below"), "upto", "rows")).alias("at")
        crossed = run.where("upto > rest").groupBy("source", "rest").agg(at)
        state = pinned(crossed.select("source", "rest", F.col("at.b").alias("bucket"), *[F.col(f"at.{c}").alias(c) for c in ("below", "upto", "rows")]))
    one = F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")
    several = F.ceil((F.col("rest") - F.col("below")) * F.col("rows") / (F.col("upto") - F.col("below")) - 0.5)
    edge = state.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("edge"),
        F.col("rows").alias("edge_rows"),
        F.when(F.col("rows") > 1, several).otherwise(one.cast("long")).cast("long").alias("edge_taken"),
    )
    return plan.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mix_plan(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """One row a source, from ``sizes(source, size, key)``: target, whole copies
    of every document, and the hash up to which documents are taken once more."""
    return pinned(_thresholds(sizes, pinned(source_targets(sizes, weights, share, max_repeat))))


def _copies() -> Column:
    """Copies of a document away from its source's threshold, or alone at it."""
    once_more = (F.col("key") < F.col("edge")) | ((F.col("key") == F.col("edge")) & (F.col("edge_taken") > 0))
    return F.col("copies") + F.coalesce(once_more, F.lit(False)).cast("long")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` joined with their plan, with ``times``, their copies. The rows that
    share the hash at a threshold, where there are several, are stored and numbered."""
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    if plan.where("edge_rows > 1").isEmpty():
        return rows.withColumn("times", _copies())
    tied = F.coalesce((F.col("key") == F.col("edge")) & (F.col("edge_rows") > 1), F.lit(False))
    plain = rows.where(~tied).withColumn("times", _copies())
    at_edge = stored(rows.where(tied).withColumn("__row", F.monotonically_increasing_id()), "mix-edge")
    part = F.shiftright("__row", 33)
    counts = at_edge.groupBy("s", part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("s").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("s").alias("__s"), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("s", "__part").orderBy("__row"))
    numbers = at_edge.select("s", "__row", part.alias("__part")).withColumn("__place", place)
    numbers = numbers.join(starts, F.col("s").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p"))).select(F.col("__row").alias("__r"), (F.col("__before") + F.col("__place")).alias("__number"))
    numbered = at_edge.join(numbers, F.col("__row") == F.col("__r")).withColumn("times", F.col("copies") + (F.col("__number") <= F.col("edge_taken")).cast("long"))
    return plain.unionByName(numbered.select(*plain.columns))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, scratch: Scratch | None = None) -> DataFrame:
    return stored(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), hash_key(F.col(id_col), F.col(text_col)).alias("key")),
        "mix-sizes",
        scratch=scratch,
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``(<id_col>, size, source_size, target, taken, source, copies)`` for every
    row: ``copies`` is how often the mix takes the document, ``taken`` the words
    of these copies. The options are those of :func:`mix_plan`."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    plan = mix_plan(sizes, **options).withColumnRenamed("source", "s")
    taken = _taken(sizes, plan)
    return taken.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", F.col("times").alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken. The
    texts are not shuffled: they meet a plan of one row a source."""
    scratch = Scratch(docs.sparkSession)
    plan = mix_plan(_sizes(docs, id_col, text_col, source_col, scratch), **options).withColumnRenamed("source", "s")
    scratch.remove()
    plan = plan.select("s", "copies", "edge", "edge_rows", "edge_taken")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(source_col).alias("source"), hash_key(F.col(id_col), F.col(text_col)).alias("key"))
    rows = _taken(rows, plan).where("times > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc.*")
