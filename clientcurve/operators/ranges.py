"""Lookup of values in inclusive ranges: any ranges, any number of them.

Ranges may overlap, be negative, empty of values, or end at infinity. There are two
ways, chosen by the counted size of the dimension:

* up to ``SMALL_RANGES``: their sorted bounds cut the numbers into cells over which
  the set of covering ranges does not change. A value finds its cell by a binary
  search, written as one expression of nested comparisons, and the cell's ranges in
  a table of at most SMALL_RANGES * 2 * SMALL_RANGES rows, which is broadcast.

* beyond: a band join over ranks. The distinct values (a hot value is one of them)
  and all bounds are sorted together across the cluster, and a running count gives
  each value its rank and each range the ranks [a, b) that it covers. A range is
  filed under the few aligned blocks of 2**l ranks that make up [a, b) exactly, at
  most two a level; a distinct value learns on which levels the block that it lies
  in has ranges, and its rows ask for those blocks. That is an equi-join whose every
  hit is a true one: its output is the result, and only what is asked and filed is
  shuffled. Rows asking for a large block are dealt over shares of it.

The joins of the second way are sort-merge joins by hint: Spark's estimate of a stored
table and of an explode knows nothing of their rows, and a table of all values that it
takes for small would be broadcast through the driver.

Values are compared as doubles. Null and NaN are in no range; a range with a null or
NaN bound, or lo > hi, holds nothing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .prefix import ordered_sum

SMALL_RANGES = 64
_V, _CELL, _SPREAD = "_rg_v", "_rg_cell", "_rg_spread"
_LEVEL, _BLOCK, _SHARE = "_rg_level", "_rg_block", "_rg_share"


def range_lookup(df: DataFrame, dim: DataFrame, value: Column, out: dict[str, str], lo: str = "lo", hi: str = "hi", small: int = SMALL_RANGES) -> DataFrame:
    """``df`` left-joined with the ranges of ``dim`` that hold ``value``: a row a
    range, and one row with nulls where there is none. ``out`` names the columns
    taken over from ``dim``, as {new name: column of dim}."""
    ranges = dim.select(*[F.col(c).alias(n) for n, c in out.items()], F.col(lo).cast("double").alias("_lo"), F.col(hi).cast("double").alias("_hi"))
    ranges = ranges.where((F.col("_lo") <= F.col("_hi")) & ~F.isnan("_lo") & ~F.isnan("_hi"))
    v = value.cast("double")
    # 0.0 + v turns the negative zero into the positive one.
    rows = df.withColumn(_V, F.when(~F.isnan(v), F.lit(0.0) + v))
    found = ranges.limit(small + 1).collect()
    names = list(out)
    if len(found) <= small:
        return _by_cells(rows, found, ranges, names).select(*df.columns, *names)
    return _by_ranks(rows, ranges, names).select(*df.columns, *names)


# ------------------------------------------------------------------ few ranges
def _literal(x: float) -> str:
    return f"double('{x!r}')" if math.isinf(x) else f"{x!r}D"


def _search(cuts: list[float], a: int, b: int) -> str:
    """SQL of the number of cuts that are not above the value, given that it lies
    between a and b."""
    if a == b:
        return str(a)
    mid = (a + b) // 2
    return f"CASE WHEN {_V} < {_literal(cuts[mid])} THEN {_search(cuts, a, mid)} ELSE {_search(cuts, mid + 1, b)} END"


def _by_cells(rows: DataFrame, found: list, ranges: DataFrame, names: list[str]) -> DataFrame:
    # [lo, hi] is [lo, next double after hi); a range up to infinity has no end.
    spans = [(r["_lo"] + 0.0, math.nextafter(r["_hi"], math.inf) if r["_hi"] < math.inf else None, r) for r in found]
    cuts = sorted({s[0] for s in spans} | {s[1] for s in spans if s[1] is not None})
    cells = [
        (i + 1, *[r[n] for n in names])
        for i, cut in enumerate(cuts)
        for a, b, r in spans
        if a <= cut and (b is None or cut < b)
    ]
    kinds = ", ".join(f"`{n}` {ranges.schema[n].dataType.simpleString()}" for n in names)
    table = rows.sparkSession.createDataFrame(cells, f"{_CELL} int, {kinds}")
    cell = F.when(F.col(_V).isNotNull(), F.expr(_search(cuts, 0, len(cuts)) if cuts else "0"))
    return rows.withColumn(_CELL, cell.cast("int")).join(F.broadcast(table), _CELL, "left")


# ------------------------------------------------------------------ many ranges
def _by_ranks(rows: DataFrame, ranges: DataFrame, names: list[str]) -> DataFrame:
    ranges = materialize(ranges.withColumn("_rid", F.monotonically_increasing_id()))
    values = rows.where(F.col(_V).isNotNull()).select(F.col(_V).alias("x")).distinct()
    none = F.lit(None).cast("long")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    # At equal numbers a lower bound stands before the value, an upper one after it.
    line = (
        values.select("x", F.lit(1).alias("kind"), one.alias("one"), none.alias("_rid"))
        .unionByName(ranges.select((F.lit(0.0) + F.col("_lo")).alias("x"), F.lit(0).alias("kind"), zero.alias("one"), "_rid"))
        .unionByName(ranges.select((F.lit(0.0) + F.col("_hi")).alias("x"), F.lit(2).alias("kind"), zero.alias("one"), "_rid"))
    )
    order = [F.col("x").asc(), F.col("kind").asc(), F.col("_rid").asc_nulls_first()]
    line = materialize(ordered_sum(line, "one", order, "rank", total_out=None))
    bounds = line.where("kind <> 1").groupBy("_rid").agg(F.max(F.when(F.col("kind") == 0, F.col("rank"))).alias("a"), F.max(F.when(F.col("kind") == 2, F.col("rank"))).alias("b"))
    highest = bounds.agg(F.max("b")).first()[0] or 0
    levels = F.explode(F.sequence(F.lit(0), F.lit(int(highest).bit_length()))).alias("level")
    # On level l, ceil(a / 2^l) and floor(b / 2^l) bound what is left; an odd end is a block of its own.
    per_level = bounds.where("a < b").select("_rid", "a", "b", levels)
    per_level = per_level.selectExpr("_rid", "level", "shiftright(a + shiftleft(1L, level) - 1, level) AS a", "shiftright(b, level) AS b").where("a < b")
    filed = per_level.select("_rid", F.col("level").alias(_LEVEL), F.explode(F.expr("filter(array(IF(a % 2 = 1, a, NULL), IF(b % 2 = 1, b - 1, NULL)), x -> x IS NOT NULL)")).alias(_BLOCK))
    filed = materialize(filed.hint("merge").join(ranges.select("_rid", *names), "_rid").drop("_rid"))
    used = sorted(r[_LEVEL] for r in filed.select(_LEVEL).distinct().collect())  # at most 64
    asked = line.where("kind = 1").select("x", (F.col("rank") - 1).alias("at"), F.explode(F.array(*[F.lit(u) for u in used]).cast("array<int>")).alias(_LEVEL))
    # The largest blocks have 16 shares, those of half their ranks 8, and so on.
    of = f"shiftleft(1L, greatest(0, {_LEVEL} - {int(highest).bit_length() - 5}))"
    shares = filed.withColumn(_SHARE, F.explode(F.expr(f"sequence(0L, {of} - 1)")))
    asked = asked.withColumns({_BLOCK: F.expr(f"shiftright(at, {_LEVEL})"), _SHARE: F.expr(f"pmod(at, {of})")})
    held = asked.hint("merge").join(shares.select(_LEVEL, _BLOCK, _SHARE).distinct(), [_LEVEL, _BLOCK, _SHARE], "left_semi")
    # The levels on which a value is held, as bits.
    held = held.groupBy(F.col("x").alias("_rg_x"), F.lit(0).cast("long").alias("_rg_s")).agg(F.max("at").alias("_rg_at"), F.bit_or(F.expr(f"shiftleft(1L, {_LEVEL})")).alias("_rg_held"))
    # Values in no range join nothing; spread over the reducers, nulls are no hot key.
    spread = rows.withColumn(_SPREAD, F.when(F.col(_V).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long")))
    asking = spread.hint("merge").join(held, (F.col(_V) == F.col("_rg_x")) & (F.col(_SPREAD) == F.col("_rg_s")), "left")
    on = F.filter(F.array(*[F.when(F.bit_get("_rg_held", F.lit(u)) == 1, F.lit(u)) for u in used]).cast("array<int>"), lambda x: x.isNotNull())
    asking = asking.withColumn(_LEVEL, F.explode_outer(on))
    asking = asking.withColumn(_BLOCK, F.when(F.col(_LEVEL).isNull(), F.xxhash64(_V, _SPREAD)).otherwise(F.expr(f"shiftright(_rg_at, {_LEVEL})")))
    asking = asking.withColumn(_SHARE, F.expr(f"coalesce(pmod(_rg_at, {of}), 0L)"))
    return asking.hint("merge").join(shares, [_LEVEL, _BLOCK, _SHARE], "left")
