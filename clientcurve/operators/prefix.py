"""Exact running total over a global order without a single-partition window.

``sum(x).over(Window.orderBy(...))`` moves every row into one task. Instead:

1. range-partition the rows on the full order key (value, tie-break). Spark
   samples the *composite* key for the bounds, so even a value shared by a
   third of the rows is split across partitions by the tie-break column;
2. one window pass per range partition gives the running total inside the
   partition (partition id taken from ``spark_partition_id``; a range
   exchange on that id gives each range its own reducer);
3. that result is checkpointed to the shared checkpoint folder: the range
   bounds come from a sample, and pinning the partition ids keeps the next
   two steps consistent even if executors are lost and work is recomputed;
4. partition totals (one row per partition) get an exclusive prefix sum and
   the grand total, and are broadcast back (size bounded by the partition
   count, not by the data).

Sums are exact (a DECIMAL value is summed with 38 digits),
so the result does not depend on the partitioning: it equals the
single-partition window bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_PART = "_rs_part"
_LOCAL = "_rs_local"
_TOTAL = "_rs_total"
_OFFSET = "_rs_offset"
_GRAND = "_rs_grand"


def running_sum(
    df: DataFrame,
    value: str,
    tiebreak: str,
    out: str = "cum",
    total_out: str | None = "total",
    descending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = running total of ``value`` in ``(value, tiebreak)`` order
    (ROWS frame: ties on ``value`` are ordered by ``tiebreak``, never merged),
    and optionally ``total_out`` = the grand total."""
    v = F.col(value)
    return ordered_sum(df, value, [v.desc() if descending else v.asc(), F.col(tiebreak).asc()], out, total_out, num_partitions)


def ordered_sum(
    df: DataFrame,
    value: str,
    order: list[Column],
    out: str = "cum",
    total_out: str | None = "total",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = running total of ``value`` in the given order, which must be
    total or its ties interchangeable, and optionally ``total_out``.

    A DECIMAL value of scale s is summed as DECIMAL(38, s), so no total that the
    type can hold overflows, whatever the ANSI setting."""
    v = F.col(value)
    kind = df.schema[value].dataType
    wide = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else None

    def exact(c):
        return c if wide is None else c.cast(wide)

    # Without an explicit count AQE sizes the range partitions from the data
    # (coalescing merges neighbouring ranges, so partition ids stay in order).
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = ranged.withColumn(_PART, F.spark_partition_id())
    # Bring each range to its own partition for the per-range window: the ids
    # are distinct and sorted, so a range exchange maps them one to one (a hash
    # exchange may put two ranges on one reducer), and the window then needs no
    # further exchange.
    ranged = ranged.repartitionByRange(_PART)
    w_local = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = materialize(ranged.withColumn(_LOCAL, exact(F.sum(exact(v)).over(w_local))))

    totals = local.groupBy(_PART).agg(exact(F.sum(exact(v))).alias(_TOTAL))
    # One row per range partition: a single-partition window is fine here.
    w_prev = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        _PART,
        exact(F.coalesce(F.sum(_TOTAL).over(w_prev), F.lit(0))).alias(_OFFSET),
        exact(F.sum(_TOTAL).over(w_all)).alias(_GRAND),
    )

    res = local.join(F.broadcast(offsets), _PART).withColumn(out, exact(F.col(_LOCAL) + F.col(_OFFSET)))
    if total_out:
        res = res.withColumn(total_out, F.col(_GRAND))
    return res.drop(_PART, _LOCAL, _OFFSET, _GRAND)
