"""Recency / demand / monetary profile per group, and segment lookup by
inclusive ranges."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between, lit_date
from .ranges import range_lookup


def rdm_profile(mean_demand: DataFrame, group_rev: DataFrame, group_span: DataFrame, as_of: _dt.date) -> DataFrame:
    """(econ_group, mean_demand, gross, first_billed, last_billed,
    days_since_last) for every group of ``mean_demand``."""
    return (
        mean_demand.join(group_rev.select("econ_group", "gross"), "econ_group", "left")
        .join(group_span.select("econ_group", "first_billed", "last_billed"), "econ_group", "left")
        .withColumn("days_since_last", days_between(lit_date(as_of), F.col("last_billed")))
    )


def segment(df: DataFrame, dim: DataFrame, value: str, out: str, precision: int | None = None) -> DataFrame:
    """Add ``out`` = the dimension segment whose inclusive ``[lo, hi]`` holds
    ``value``; null when the value falls in a gap or is null. Ranges may be
    infinite, overlap (a row a segment) and be of any number, see ``ranges``.

    With ``precision`` the value is rounded first, so a floating-point mean
    that prints as a bound (0.04) is classified like the bound, whatever the
    summation order that produced it."""
    v = F.col(value) if precision is None else F.round(F.col(value), precision)
    return range_lookup(df, dim, v, {out: "segment"})
