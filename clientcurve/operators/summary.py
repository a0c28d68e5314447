"""Report tables: changes per curve class, groups that moved class, and the
report route of a run date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.labels import curve_label, trend, weekday_label, weekday_number
from ..functions.nulls import flag_is_one


def curve_summary(changed: DataFrame) -> DataFrame:
    """(curve, orgs, groups) per computed class among the changed
    organisations: organisation count and distinct non-null groups. Classes
    A/B/C are labelled, other ids shown as their number."""
    return (
        changed.where(F.col("curve").isNotNull())
        .groupBy("curve")
        .agg(F.count("curve").alias("orgs"), F.countDistinct("econ_group").alias("groups"))
        .select(curve_label("curve").alias("curve"), "orgs", "groups")
    )


def curve_movers(changed: DataFrame) -> DataFrame:
    """(econ_group, old_curve, new_curve, old_label, new_label, trend) for the
    groups whose class changed: lowest stored and lowest computed class of the
    group's changed organisations; 'up' when the id went down (A < B < C)."""
    moved = (
        changed.where(flag_is_one("curve_changed") & F.col("econ_group").isNotNull())
        .groupBy("econ_group")
        .agg(F.min("crm_curve").alias("old_curve"), F.min("curve").alias("new_curve"))
    )
    return moved.select(
        "econ_group",
        "old_curve",
        "new_curve",
        curve_label("old_curve").alias("old_label"),
        curve_label("new_curve").alias("new_label"),
        trend("new_curve", "old_curve").alias("trend"),
    )


def status_movers(changed: DataFrame) -> DataFrame:
    """(id, econ_group, movement) for the organisations whose status changed:
    'inactive' for those that are now inactive, 'active' for all others."""
    return changed.where(flag_is_one("status_changed")).select(
        "id", "econ_group", F.when(F.col("status") == C.ORG_INACTIVE, F.lit("inactive")).otherwise(F.lit("active")).alias("movement")
    )


def report_route(run_dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """(run_date, weekday, weekday_label, reports) per distinct run date: the
    weekly report goes out together with the daily one on the weekly day."""
    d = F.col(date_col)
    days = run_dates.select(d.alias("run_date")).where(F.col("run_date").isNotNull()).distinct()
    wd = weekday_number("run_date")
    return days.select(
        "run_date",
        wd.alias("weekday"),
        weekday_label("run_date").alias("weekday_label"),
        F.when(wd == C.WEEKLY_WEEKDAY, F.lit("weekly,daily")).otherwise(F.lit("daily")).alias("reports"),
    )
