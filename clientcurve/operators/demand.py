"""Month-over-month demand: relative change of the active headcount against
the group's previous *present* month, and its mean per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import round_exact


def demand_mom(headcount: DataFrame) -> DataFrame:
    """(econ_group, month, active, prev_active, demand, pct).

    ``demand = (active - prev) / prev`` with prev the previous month present
    for the group (a gap month is skipped, not read as 0). No previous month
    or a zero previous headcount gives 0, and rows with demand 0 are dropped,
    so a group's first month never appears. ``pct`` is 100 x demand, its exact
    binary value rounded to 2 places.

    The window is partitioned by group, and a group has at most one row per
    window month, so no partition can grow with the data."""
    w = Window.partitionBy("econ_group").orderBy("month")
    prev = F.lag("active").over(w)
    d = F.coalesce(F.try_divide((F.col("active") - prev).cast("double"), prev.cast("double")), F.lit(0.0))
    return (
        headcount.select("econ_group", "month", "active", prev.alias("prev_active"), d.alias("demand"))
        .where(F.col("demand") != 0)
        .withColumn("pct", round_exact(F.col("demand") * 100, 2))
    )


def mean_demand(demand: DataFrame, groups: DataFrame) -> DataFrame:
    """(econ_group, mean_demand) for every group of ``groups``; null when the
    group has no demand row."""
    means = demand.groupBy("econ_group").agg(F.avg("demand").alias("mean_demand"))
    return groups.select("econ_group").join(means, "econ_group", "left")
