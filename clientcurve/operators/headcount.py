"""Active headcount per economic group and month.

Employees are first reduced to intervals: (group, admission month, dismissal
month) -> headcount. An interval is active in month m when
``admission <= m <= dismissal`` (no dismissal = open). Instead of joining a
(month x group) grid with the intervals and filtering (a cross product),
each interval emits the months it covers inside the window with
``explode(sequence(...))`` and the counts are summed per (group, month). The
fan-out per interval is at most the number of months in the window, and the
sum is partially aggregated map-side, so a group holding a third of all
employees is still spread over all tasks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import month_key


def headcount_intervals(employees: DataFrame, code_map: DataFrame) -> DataFrame:
    """(econ_group, adm_month, dem_month, headcount): employees counted per
    client and (admission, dismissal) month, resolved to the groups owning the
    client's code. Employees without a code are not counted; a missing
    dismissal becomes the open month. Clients without a group drop out."""
    per_client = employees.groupBy(
        "client_code",
        month_key("admitted").alias("adm_month"),
        month_key("dismissed").alias("dem_month"),
    ).agg(F.count("employee_code").alias("n"))
    m = code_map.where(F.col("econ_group").isNotNull()).select("code", "econ_group")
    joined = per_client.join(m, per_client["client_code"] == m["code"], "inner")
    return joined.groupBy(
        "econ_group", "adm_month", F.coalesce(F.col("dem_month"), F.lit(C.OPEN_MONTH)).alias("dem_month")
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("headcount"))


def _window_months(start: _dt.date, end: _dt.date) -> tuple[int, int]:
    """Month indices (year * 12 + month - 1) of the first and last month start
    inside ``[start, end]``."""
    first = start if start.day == 1 else (start.replace(day=1) + _dt.timedelta(days=32)).replace(day=1)
    return first.year * 12 + first.month - 1, end.year * 12 + end.month - 1


def _index_of(month) -> "F.Column":
    """'yyyyMM' -> month index; text order and index order agree."""
    m = F.col(month) if isinstance(month, str) else month
    return F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 5, 2).cast("int") - 1


def _key_of(index) -> "F.Column":
    """Month index -> 'yyyyMM'."""
    return F.lpad((F.floor(index / 12) * 100 + index % 12 + 1).cast("bigint").cast("string"), 6, "0")


def active_headcount(
    intervals: DataFrame, active_groups: DataFrame, start: _dt.date, end: _dt.date
) -> DataFrame:
    """(econ_group, month 'yyyyMM', active): headcount of the intervals covering
    each month start of ``[start, end]``, for the groups in ``active_groups``.
    A (group, month) that no interval covers is absent, not 0.

    Months are expanded as integer indices and turned back into keys only
    after the sum, so the per-row work of the expansion is integer work."""
    first, last = _window_months(start, end)
    iv = intervals.where(F.col("adm_month").isNotNull()).join(
        active_groups.select("econ_group"), "econ_group", "left_semi"
    )
    lo = F.greatest(_index_of("adm_month"), F.lit(first))
    hi = F.least(_index_of("dem_month"), F.lit(last))
    months = F.when(lo <= hi, F.sequence(lo, hi))
    return (
        iv.select("econ_group", F.explode(months).alias("m"), "headcount")
        .groupBy("econ_group", "m")
        .agg(F.sum("headcount").alias("active"))
        .select("econ_group", _key_of(F.col("m")).alias("month"), "active")
    )
