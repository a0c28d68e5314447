"""Month calendar of the analysis window and the (month, group) grid.

Both are generated with ``explode(sequence(...))`` next to the rows that need
them: no cross join, and the output per input row is bounded by the number of
months in the window."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_starts_between


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, _dt.date):
        return lit_date(x)
    return F.col(x)


def month_calendar(bounds: DataFrame, start="start", end="end") -> DataFrame:
    """(month_start DATE, month INT yyyyMM) for every month start inside
    ``[start, end]`` of each bounds row (a partial first month is left out)."""
    starts = F.explode(month_starts_between(_as_col(start), _as_col(end))).alias("month_start")
    return bounds.select(starts).select(
        "month_start", F.date_format("month_start", "yyyyMM").cast("int").alias("month")
    )


def group_month_grid(groups: DataFrame, start, end) -> DataFrame:
    """(econ_group, month INT yyyyMM): every group paired with every month of
    the window, generated per group row."""
    m = F.explode(month_starts_between(_as_col(start), _as_col(end))).alias("month_start")
    return groups.select("econ_group", m).select(
        "econ_group", F.date_format("month_start", "yyyyMM").cast("int").alias("month")
    )
