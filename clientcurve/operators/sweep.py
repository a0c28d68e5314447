"""Headcount by sweep line, over a calendar of any length and step.

``active_headcount`` emits a row for each month that an interval covers; over twenty
years, or by the day, that is hundreds or thousands of rows an interval. The sweep
emits two: +n where the interval begins and -n after it ends. Their sums by (key,
point) are partial before the shuffle, and a running sum along a key's points gives
the count between any two of them. A key has at most one point a calendar step, so
its window stays small, however many intervals it has."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .headcount import _index_of, _key_of, _window_months


def covered_runs(intervals: DataFrame, key: str, lo: Column, hi: Column, weight: Column, first: int | Column, last: int | Column) -> DataFrame:
    """(key, start, stop, active): the longest runs of whole-number points inside
    ``[first, last]`` over which the summed ``weight`` of the intervals ``[lo, hi]``
    covering them (bounds inclusive) does not change. Points that no interval
    covers are absent, not 0. Null bounds, and hi < lo, are no interval; a null key
    is dropped."""
    first, last = (F.lit(x) if isinstance(x, int) else x for x in (first, last))
    rows = intervals.select(
        F.col(key).alias("k"), F.greatest(lo.cast("long"), first.cast("long")).alias("lo"), F.least(hi.cast("long"), last.cast("long")).alias("hi"),
        weight.cast("long").alias("n"), lo.isNull().alias("no_lo"), hi.isNull().alias("no_hi"),
    )
    rows = rows.where(F.col("k").isNotNull() & ~F.col("no_lo") & ~F.col("no_hi") & (F.col("lo") <= F.col("hi")))
    ends = F.explode(F.array(F.struct(F.col("lo").alias("at"), F.col("n").alias("n"), F.lit(1).alias("c")), F.struct((F.col("hi") + 1).alias("at"), (-F.col("n")).alias("n"), F.lit(-1).alias("c"))))
    points = rows.select("k", ends.alias("e")).groupBy("k", "e.at").agg(F.sum("e.n").alias("n"), F.sum("e.c").alias("c"))
    along = Window.partitionBy("k").orderBy("at")
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = points.select("k", "at", F.sum("n").over(running).alias("active"), (F.sum("c").over(running) > 0).alias("covered"))
    same = (F.col("active") == F.lag("active").over(along)) & (F.col("covered") == F.lag("covered").over(along))
    turns = state.withColumn("same", F.coalesce(same, F.lit(False))).where(~F.col("same"))
    runs = turns.withColumn("stop", F.lead("at").over(along) - 1)
    return runs.where("covered").select(F.col("k").alias(key), F.col("at").alias("start"), "stop", "active")


def headcount_by_sweep(intervals: DataFrame, active_groups: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """The frame of ``active_headcount``, (econ_group, month 'yyyyMM', active), by
    the sweep; months appear only after the counts are known."""
    first, last = _window_months(start, end)
    rows = intervals.join(active_groups.select("econ_group"), "econ_group", "left_semi")
    runs = covered_runs(rows, "econ_group", _index_of("adm_month"), _index_of("dem_month"), F.col("headcount"), first, last)
    months = runs.select("econ_group", F.explode(F.sequence("start", "stop")).alias("m"), "active")
    return months.select("econ_group", _key_of(F.col("m")).alias("month"), "active")


def daily_headcount_runs(employees: DataFrame, code_map: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """(econ_group, from_date, to_date, active): days on which the headcount of a
    group stays the same, from the employees' dates themselves. Employees are
    counted per client and pair of dates before they meet the groups."""
    open_end = F.coalesce(F.col("dismissed"), F.lit(end))
    per_client = employees.groupBy("client_code", "admitted", open_end.alias("until")).agg(F.count("employee_code").alias("n"))
    codes = code_map.where(F.col("econ_group").isNotNull()).select("code", "econ_group")
    rows = per_client.join(codes, per_client["client_code"] == codes["code"], "inner")
    epoch = _dt.date(1970, 1, 1)
    runs = covered_runs(rows, "econ_group", F.unix_date("admitted"), F.unix_date("until"), F.col("n"), (start - epoch).days, (end - epoch).days)
    return runs.select("econ_group", F.date_from_unix_date(F.col("start").cast("int")).alias("from_date"), F.date_from_unix_date(F.col("stop").cast("int")).alias("to_date"), "active")
