"""Change detection: computed values against the CRM snapshot.

Flags are 1/0 integers with null meaning "not applicable" (kept from the
original job, where they drive both the change filter and the payload)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.nulls import flag_is_one, pandas_ne, pandas_ne_flag

FLAG_COLUMNS = ["billing_changed", "status_changed", "curve_changed", "group_status_changed"]


def billing_flag_columns(include_first: bool = False) -> dict:
    """``first_changed`` / ``last_changed``: computed date differs from the
    stored one (a null on either side counts as different).
    ``billing_changed``: null when there is no computed last date, else 1 if
    the last date changed (or, with ``include_first``, either date)."""
    first_changed = pandas_ne("first_billed", "crm_first")
    last_changed = pandas_ne("last_billed", "crm_last")
    any_changed = (last_changed | first_changed) if include_first else last_changed
    return {
        "first_changed": first_changed,
        "last_changed": last_changed,
        "billing_changed": F.when(F.col("last_billed").isNull(), F.lit(None).cast("int")).otherwise(
            any_changed.cast("int")
        ),
    }


def status_flag_column():
    """``status_changed``: null when never billed, else stored != computed."""
    return F.when(F.col("days_since_last").isNull(), F.lit(None).cast("int")).otherwise(
        pandas_ne_flag("crm_status", "status")
    )


def curve_flag_column():
    """``curve_changed``: no stored class and no computed class is no change;
    otherwise stored != computed."""
    curve = F.col("curve")
    return (
        F.when(curve.isNull(), F.lit(None).cast("int"))
        .when(F.col("crm_curve").isNull() & (curve == C.CURVE_NONE), F.lit(0))
        .otherwise(pandas_ne_flag("crm_curve", curve))
    )


def group_status_flag_column():
    """``group_status_changed``: no stored status and a never-active group is
    no change; otherwise stored != computed (so organisations without a
    group, whose computed status is null, always count as changed)."""
    gs = F.col("group_status")
    unchanged_default = F.coalesce(F.col("crm_group_status").isNull() & (gs == C.GROUP_NEVER), F.lit(False))
    return F.when(unchanged_default, F.lit(0)).otherwise(pandas_ne_flag("crm_group_status", gs))


def flag_billing_change(df: DataFrame, include_first: bool = False) -> DataFrame:
    return df.withColumns(billing_flag_columns(include_first))


def flag_status_change(df: DataFrame) -> DataFrame:
    return df.withColumn("status_changed", status_flag_column())


def flag_curve_change(df: DataFrame) -> DataFrame:
    return df.withColumn("curve_changed", curve_flag_column())


def flag_group_status_change(df: DataFrame) -> DataFrame:
    return df.withColumn("group_status_changed", group_status_flag_column())


def flag_changes(df: DataFrame, include_first: bool = False) -> DataFrame:
    """All four flags in one projection."""
    cols = billing_flag_columns(include_first)
    cols["status_changed"] = status_flag_column()
    cols["curve_changed"] = curve_flag_column()
    cols["group_status_changed"] = group_status_flag_column()
    return df.withColumns(cols)


def changed_orgs(df: DataFrame) -> DataFrame:
    """Organisations with at least one flag equal to 1 (null flags do not count)."""
    cond = F.lit(False)
    for c in FLAG_COLUMNS:
        cond = cond | flag_is_one(c)
    return df.where(cond)
