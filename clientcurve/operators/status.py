"""Activity status of organisations and its roll-up to economic groups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import days_between, lit_date
from .abc import lone_key


def activity_status(df: DataFrame, as_of: _dt.date, active_days: int = C.ACTIVE_DAYS) -> DataFrame:
    """Add ``days_since_last`` (from ``last_billed`` to the run date) and
    ``status``: active within ``active_days``, inactive after, null when the
    organisation never billed."""
    days = days_between(lit_date(as_of), F.col("last_billed"))
    status = F.when(days.isNull(), F.lit(None).cast("int")).when(days <= active_days, F.lit(C.ORG_ACTIVE))
    status = status.otherwise(F.lit(C.ORG_INACTIVE))
    return df.withColumns({"days_since_last": days, "status": status})


def group_status_rollup(df: DataFrame, active_days: int = C.ACTIVE_DAYS) -> DataFrame:
    """Replace ``group_status`` by its group-level value.

    First an organisation of a never-active group that stopped billing more
    than ``active_days`` ago marks its group inactive. Then each group takes
    active if any member is active, else inactive if any member is inactive,
    else never active: with the ids 654 < 655 < 700 that is the minimum.
    Organisations without a group get null.

    Done as a grouped aggregate joined back (map-side partial minimums, a
    per-group table that AQE broadcasts or skew-splits) rather than a window
    partitioned by group, which would put a hot group in one task."""
    lapsed = F.coalesce(F.col("days_since_last") > active_days, F.lit(False))
    marked = df.withColumn(
        "_gs1",
        F.when(lapsed & (F.col("group_status") == C.GROUP_NEVER), F.lit(C.GROUP_INACTIVE)).otherwise(
            F.col("group_status")
        ),
    )
    per_group = (
        marked.where(F.col("econ_group").isNotNull())
        .groupBy(F.col("econ_group").alias("_k"))
        .agg(F.min("_gs1").alias("_gs_group"))
    )
    # Organisations without a group match nothing, by keys of their own: null status, no hot key.
    joined = marked.withColumn("_k", lone_key()).join(per_group, "_k", "left")
    return joined.select(*[F.col("_gs_group").alias(c) if c == "group_status" else F.col(f"`{c}`") for c in df.columns])
