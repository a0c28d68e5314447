"""ABC curve: groups ranked by window revenue; the running revenue share
(including the group itself) decides the class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .prefix import running_sum


def curve_class(share, a_max: float = C.CURVE_A_MAX_SHARE, b_max: float = C.CURVE_B_MAX_SHARE) -> Column:
    """<= a_max -> A, (a_max, b_max] -> B, > b_max -> C, null share -> no class."""
    s = F.col(share) if isinstance(share, str) else share
    return (
        F.when(s <= a_max, F.lit(C.CURVE_A))
        .when((s > a_max) & (s <= b_max), F.lit(C.CURVE_B))
        .when(s > b_max, F.lit(C.CURVE_C))
        .otherwise(F.lit(C.CURVE_NONE))
    )


def cumulative_revenue(group_rev: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(econ_group, gross, cum_gross, total_gross) in descending revenue order,
    ties broken by group name."""
    return running_sum(
        group_rev, "gross", "econ_group", out="cum_gross", total_out="total_gross", num_partitions=num_partitions
    )


def abc_classify(
    group_rev: DataFrame,
    a_max: float = C.CURVE_A_MAX_SHARE,
    b_max: float = C.CURVE_B_MAX_SHARE,
    num_partitions: int | None = None,
) -> DataFrame:
    """(econ_group, gross, cum_gross, cum_share, curve, group_status).

    A first group whose own share exceeds ``a_max`` is not A; a zero total
    gives a null share and the "no class" id. Every group here billed inside
    the window, so its group status is "active"."""
    ranked = cumulative_revenue(group_rev, num_partitions)
    share = F.try_divide(F.col("cum_gross").cast("double"), F.col("total_gross").cast("double"))
    return ranked.select(
        "econ_group",
        "gross",
        "cum_gross",
        share.alias("cum_share"),
        curve_class(share, a_max, b_max).alias("curve"),
        F.lit(C.GROUP_ACTIVE).alias("group_status"),
    )


def org_abc(orgs: DataFrame, abc: DataFrame) -> DataFrame:
    """Every column of ``orgs`` plus ``curve`` and ``group_status``: the class of
    the organisation's group, "no class" and "never active" when the group had
    no revenue (or the organisation has no group).

    ``abc`` has one row per group; AQE broadcasts it when its runtime size is
    small and otherwise splits a hot group on the organisation side.
    Organisations without a group join on a key of their own (``lone_key``), so
    they are no hot (null) key and the frame is read once."""
    g = abc.select(F.col("econ_group").alias("_k"), F.col("curve").alias("_curve"), F.col("group_status").alias("_gs"))
    return orgs.withColumn("_k", lone_key()).join(g, "_k", "left").select(
        *[F.col(f"`{c}`") for c in orgs.columns],
        F.coalesce("_curve", F.lit(C.CURVE_NONE)).alias("curve"),
        F.coalesce("_gs", F.lit(C.GROUP_NEVER)).alias("group_status"),
    )


def lone_key(group: str = "econ_group", row_id: str = "id") -> Column:
    """The group, or, where it is null, a text that no group has and that differs
    between organisations: it matches nothing and spreads over all reducers."""
    lone = F.concat(F.lit("\0"), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    return F.when(F.col(group).isNull(), lone).otherwise(F.col(group))
