"""Named queries over the driver's Parquet tables: one per operator group of
columns have stable, engine-neutral types: BIGINT counts and codes, DOUBLE
money rounded to cents, ratios rounded to 6 places, dates as ISO text.

Every query reads the whole of the tables it uses; the run date is the fixed
parameter ``RunConfig.as_of`` (the last order date of the fixture data).
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import operators as O
from ..config import RunConfig
from ..functions.dates import coerce_date
from ..functions.exact import round_exact
from ..operators import billing_state, distinct_sketch, sweep
from ..operators import ranges as ranges_
from ..session import ensure_checkpoint_dir, materialize, shared_path
from ..sinks import writers
from ..sources import dims, quarantine, readers
from ..sources.fixtures import FixtureTables
from .billing_run import BillingRun

# Run dates of the two-run history queries: a weekly run before the main one.
PREVIOUS_RUN_GAP_DAYS = 7


def run_for(spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None) -> BillingRun:
    t = FixtureTables(spark, sf_dir)
    return BillingRun(t.invoices, t.employees, t.orgs, cfg or RunConfig(), delivery_log=t.delivery_log)


# ----------------------------------------------------------- output typing
# Output projections are SQL expression strings applied with one selectExpr
# (one driver round trip per query instead of several per column).
def _money(c: str) -> str:
    return f"CAST(round(`{c}`, 2) AS DOUBLE) AS `{c}`"


def _ratio(c: str) -> str:
    return f"round(CAST(`{c}` AS DOUBLE), 6) AS `{c}`"


def _iso(c: str) -> str:
    return f"date_format(`{c}`, 'yyyy-MM-dd') AS `{c}`"


def _day(c: str) -> str:
    return f"date_format(`{c}`, 'yyyyMMdd') AS `{c}`"


def _big(c: str) -> str:
    return f"CAST(`{c}` AS BIGINT) AS `{c}`"


def _ts(c: str) -> str:
    return f"date_format(`{c}`, 'yyyy-MM-dd HH:mm:ss') AS `{c}`"


def org_frame_columns() -> list[str]:
    return [
        _big("id"),
        "econ_group",
        _big("crm_curve"),
        _iso("crm_first"),
        _iso("crm_last"),
        _big("crm_status"),
        _big("crm_group_status"),
        _big("curve"),
        _big("group_status"),
        _iso("first_billed"),
        _iso("last_billed"),
        _big("days_since_last"),
        _big("status"),
        _big("first_changed"),
        _big("last_changed"),
        _big("billing_changed"),
        _big("status_changed"),
        _big("curve_changed"),
        _big("group_status_changed"),
    ]


# ---------------------------------------------------------------- revenue
def q_client_month_revenue(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.client_rev.selectExpr("client_code", "month", _money("gross"), _day("last_billed"), _day("first_billed"))


def q_client_billing_span(spark, sf_dir):
    t = FixtureTables(spark, sf_dir)
    return O.billing_span(t.invoices).selectExpr("client_code", _day("first_billed"), _day("last_billed"))


def q_org_code_explode(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.code_map.selectExpr(_big("id"), "code", "econ_group")


def q_org_code_explode_outer(spark, sf_dir):
    t = FixtureTables(spark, sf_dir)
    return O.explode_codes(t.orgs, keep_null=True).selectExpr(_big("id"), "code", "econ_group")


def q_client_group_join(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.client_group_join(r.client_rev, r.code_map).selectExpr("client_code", "month", _money("gross"), "econ_group")


def q_group_revenue(spark, sf_dir):
    """Group revenue from the client-month table (the operator as specified)."""
    r = run_for(spark, sf_dir)
    return O.group_revenue(r.client_rev, r.code_map).selectExpr("econ_group", _money("gross"))


def q_group_revenue_total(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.total_revenue(O.group_revenue(r.client_rev, r.code_map)).selectExpr(_money("total_gross"))


def q_group_cumulative_revenue(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.cumulative.selectExpr("econ_group", _money("gross"), _money("cum_gross"))


def q_abc_curve(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.abc.selectExpr(
        "econ_group", _money("gross"), _money("cum_gross"), _ratio("cum_share"), _big("curve"), _big("group_status")
    )


# ----------------------------------------------------- organisation frame
def q_org_abc(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.org_abc.selectExpr(_big("id"), "econ_group", _big("curve"), _big("group_status"))


def q_org_billing_span(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.org_abc.join(O.org_billing_span(r.orgs, r.span, r.code_map), "id", "left").selectExpr(
        _big("id"), _big("curve"), _big("group_status"), _iso("first_billed"), _iso("last_billed")
    )


def q_org_activity_status(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.org_dated.selectExpr(_big("id"), _iso("last_billed"), _big("days_since_last"), _big("status"))


def q_group_status_rollup(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.org_rollup.selectExpr(_big("id"), "econ_group", _big("group_status"))


def q_flag_billing_change(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.flag_billing_change(r.org_dated).selectExpr(
        _big("id"),
        _iso("first_billed"),
        _iso("crm_first"),
        _iso("last_billed"),
        _iso("crm_last"),
        _big("first_changed"),
        _big("last_changed"),
        _big("billing_changed"),
    )


def q_flag_status_change(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.flag_status_change(r.org_dated).selectExpr(
        _big("id"), _big("days_since_last"), _big("status"), _big("crm_status"), _big("status_changed")
    )


def q_flag_curve_change(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.flag_curve_change(r.org_rollup).selectExpr(_big("id"), _big("curve"), _big("crm_curve"), _big("curve_changed"))


def q_flag_group_status_change(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return O.flag_group_status_change(r.org_rollup).selectExpr(
        _big("id"), "econ_group", _big("group_status"), _big("crm_group_status"), _big("group_status_changed")
    )


def q_changed_orgs(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.changed.selectExpr(*org_frame_columns())


def q_curve_summary(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.curve_summary.selectExpr("curve", _big("orgs"), _big("groups"))


def q_curve_movers(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.curve_movers.selectExpr(
        "econ_group", _big("old_curve"), _big("new_curve"), "old_label", "new_label", "trend"
    )


def q_update_outbox(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.outbox.selectExpr(
        _big("id"),
        "change_code",
        _big("status"),
        _big("curve"),
        _iso("first_billed"),
        _iso("last_billed"),
        _big("group_status"),
    )


def q_update_payload_json(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.payload.selectExpr(_big("id"), "payload")


# ----------------------------------------------------- calendar and demand
def q_month_calendar(spark, sf_dir):
    """Calendar of the analysis window ending at the latest invoice date."""
    t = FixtureTables(spark, sf_dir)
    cfg = RunConfig()
    bounds = t.invoices.agg(F.max("issue_date").alias("end")).select(
        F.date_sub("end", cfg.window_days).alias("start"), "end"
    )
    return O.month_calendar(bounds).selectExpr(_big("month"), _iso("month_start"))


def q_group_month_grid(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.grid.selectExpr("econ_group", _big("month"))


def q_headcount_intervals(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.intervals.selectExpr("econ_group", "adm_month", "dem_month", _big("headcount"))


def q_active_headcount(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.headcount.selectExpr("econ_group", "month", _big("active"))


def q_demand_mom(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.demand.selectExpr(
        "econ_group", "month", _big("active"), _big("prev_active"), _ratio("demand"), "CAST(pct AS DOUBLE) AS pct"
    )


def q_mean_demand(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.mean_demand.selectExpr("econ_group", _ratio("mean_demand"))


def q_rdm_profile(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.profile.selectExpr(
        "econ_group",
        _ratio("mean_demand"),
        _money("gross"),
        _iso("first_billed"),
        _iso("last_billed"),
        _big("days_since_last"),
    )


def q_recency_segment(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.recency_segments(dims.dim_recency(spark)).selectExpr(
        "econ_group", _big("days_since_last"), "recency_segment"
    )


def q_demand_segment(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return r.demand_segments(dims.dim_demand(spark)).selectExpr("econ_group", _ratio("mean_demand"), "demand_segment")


# --------------------------------------------------- delivery and routing
def q_delivery_report(spark, sf_dir):
    t = FixtureTables(spark, sf_dir)
    return O.delivery_report(t.delivery_log, dims.http_codes(spark)).selectExpr(
        _big("org_id"), _iso("run_date"), _big("http_code"), "outcome", "description", "link"
    )


def q_report_route(spark, sf_dir):
    t = FixtureTables(spark, sf_dir)
    return O.report_route(t.delivery_log).selectExpr(_iso("run_date"), _big("weekday"), "weekday_label", "reports")


# ------------------------------------------------------------- history
def history_columns() -> list[str]:
    return [
        _big("org_id"),
        "econ_group",
        _big("crm_curve"),
        _iso("crm_first"),
        _iso("crm_last"),
        _big("crm_status"),
        _big("crm_group_status"),
        _big("curve"),
        _big("group_status"),
        _iso("first_billed"),
        _iso("last_billed"),
        _big("days_since_last"),
        _big("status"),
        _big("first_changed"),
        _big("last_changed"),
        _big("billing_changed"),
        _big("status_changed"),
        _big("curve_changed"),
        _big("group_status_changed"),
        _ts("updated_at"),
        "run_id",
        "change_code",
    ]


def _two_runs(spark, sf_dir) -> list[tuple[DataFrame, _dt.datetime]]:
    """The changed organisations of a previous weekly run and of the main run;
    the main run carries one more column (``change_code``)."""
    cfg = RunConfig()
    prev = cfg.with_as_of(cfg.as_of - _dt.timedelta(days=PREVIOUS_RUN_GAP_DAYS))
    older = run_for(spark, sf_dir, prev).changed
    newer = run_for(spark, sf_dir, cfg)
    newer_rows = newer.changed.withColumn("change_code", O.outbox_change_code())
    return [(older, prev.run_ts), (newer_rows, cfg.run_ts)]


def q_history_union(spark, sf_dir):
    runs = [writers.stamp_run(df, ts) for df, ts in _two_runs(spark, sf_dir)]
    return writers.history_union(*runs).selectExpr(*history_columns())


def q_history_append_roundtrip(spark, sf_dir):
    """Both runs appended to a history table in the shared folder, read back."""
    path = shared_path(spark, "history")
    for df, ts in _two_runs(spark, sf_dir):
        writers.append_history(df, path, ts)
    return readers.read_history(spark, path).selectExpr(*history_columns())


def q_csv_pipe_roundtrip(spark, sf_dir):
    """The organisation snapshot written as a pipe-delimited file and read back
    as text, typed by column name (codes stay text)."""
    t = FixtureTables(spark, sf_dir)
    path = shared_path(spark, "orgs-csv")
    writers.write_delimited(t.orgs, path, sep="|")
    back = readers.read_orgs_snapshot(spark, path, sep="|", columns=readers.IDENTITY_ORG_COLUMNS)
    return back.selectExpr(
        _big("id"),
        "codes",
        "econ_group",
        _big("crm_curve"),
        _iso("crm_first"),
        _iso("crm_last"),
        _big("crm_status"),
        _big("crm_group_status"),
    )


def q_status_movers(spark, sf_dir):
    return O.status_movers(run_for(spark, sf_dir).changed).selectExpr(_big("id"), "econ_group", "movement")


def q_segment_file_roundtrip(spark, sf_dir):
    """Recency segments of the profile by dimensions read from a JSON file."""
    path = shared_path(spark, "segments-json")
    names = ["R_ID", "R_Segmento", "minimo", "maximo"]
    doc = {
        "DimRecencia": [dict(zip(names, r, strict=True)) for r in C.RECENCY_SEGMENTS],
        "DimDemanda": [dict(zip(["D_ID", "D_Segmento", "minimo", "maximo"], r, strict=True)) for r in C.DEMAND_SEGMENTS],
    }
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(path)
    recency, _ = readers.read_segment_dims(spark, path)
    r = run_for(spark, sf_dir)
    return r.recency_segments(recency).selectExpr("econ_group", _big("days_since_last"), "recency_segment")


def q_http_file_roundtrip(spark, sf_dir):
    """Delivery attempts described by a semicolon file with a byte-order mark and
    a repeated header name."""
    path = shared_path(spark, "http-csv")
    lines = ["\ufeffCode;Text;Link;Text"] + [f"{c};{d};{link};" for c, d, link, _ in dims.http_code_rows()]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    report = O.delivery_report(FixtureTables(spark, sf_dir).delivery_log, readers.read_http_codes(spark, path))
    return report.groupBy("http_code", "outcome", "description").agg(F.count("*").alias("attempts")).selectExpr(_big("http_code"), "outcome", "description", "attempts")


def q_delivery_report_roundtrip(spark, sf_dir):
    """The delivery report, written as a table partitioned by run date and read back."""
    path = shared_path(spark, "delivery-report")
    writers.write_partitioned_by_run_date(O.delivery_report(FixtureTables(spark, sf_dir).delivery_log, dims.http_codes(spark)), path)
    back = spark.read.parquet(path)
    return back.groupBy("run_date", "outcome").agg(F.count("*").alias("attempts")).selectExpr(_iso("run_date"), "outcome", "attempts")


# ------------------------------------------------- incremental state, sweep, ranges
LOAD_CUT_DAYS = 30


def q_billing_state_two_runs(spark, sf_dir):
    """Billing spans and window revenue of each client, from a state that a first
    load built and a second one (new invoices, late cancellations, corrections)
    brought up to date."""
    cfg = RunConfig()
    log, state = shared_path(spark, "invoice-log"), shared_path(spark, "billing-state")
    for load, rows in FixtureTables(spark, sf_dir).invoice_loads(cfg.as_of - _dt.timedelta(days=LOAD_CUT_DAYS)):
        billing_state.append_load(rows, log, load, buckets=8)
        version = billing_state.update_state(spark, log, state, [load], cfg.as_of)
    return billing_state.state_facts(version, spark, cfg.as_of).selectExpr(
        "client_code", _day("first_billed"), _day("last_billed"), _money("window_gross"), _big("window_rows")
    )


def q_headcount_sweep(spark, sf_dir):
    r = run_for(spark, sf_dir)
    return sweep.headcount_by_sweep(r.window_intervals, r.active_groups, r.cfg.window_start, r.cfg.window_end).selectExpr("econ_group", "month", _big("active"))


DAILY_CALENDAR_DAYS = 3650


def q_headcount_daily_runs(spark, sf_dir):
    """Headcount of every group by the day, over ten years, as runs of equal days."""
    r = run_for(spark, sf_dir)
    start = r.cfg.as_of - _dt.timedelta(days=DAILY_CALENDAR_DAYS)
    return sweep.daily_headcount_runs(r.employees, r.code_map, start, r.cfg.as_of).selectExpr("econ_group", _iso("from_date"), _iso("to_date"), _big("active"))


def q_exact_rounding(spark, sf_dir):
    """Line amounts by the eighth, and their discounts about 5 %, to two places."""
    lines = FixtureTables(spark, sf_dir).raw("lineitem")
    eighth, about = F.col("l_extendedprice") / 8, F.col("l_extendedprice") * (F.col("l_discount") - 0.05) / F.col("l_quantity")
    return lines.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), round_exact(eighth, 2).alias("eighth"), round_exact(about, 2).alias("about"))


def q_segment_intervals(spark, sf_dir):
    """Customers' balances in overlapping ranges about the suppliers' balances, some
    of them without an end."""
    t = FixtureTables(spark, sf_dir)
    ranges = t.raw("supplier").selectExpr(
        "s_suppkey", "CASE WHEN s_suppkey % 50 = 2 THEN double('-Infinity') ELSE s_acctbal - 50 END AS lo", "CASE WHEN s_suppkey % 50 = 1 THEN double('Infinity') ELSE s_acctbal + 50 END AS hi"
    )
    balances = t.raw("customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 40 <> 0 THEN c_acctbal END AS balance")
    return ranges_.range_lookup(balances, ranges, F.col("balance"), {"s_suppkey": "s_suppkey"})


def q_snapshot_rejects_roundtrip(spark, sf_dir):
    """A snapshot with torn rows, ids that are no numbers and dates that are none,
    read with its bad rows set aside: what became of its rows, by reason."""
    orgs = FixtureTables(spark, sf_dir).orgs
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in readers.IDENTITY_ORG_COLUMNS]
    kind = F.col("id") % 50
    fields[0] = F.when(kind == 9, F.concat(F.lit("n"), fields[0])).when(kind == 17, F.lit("")).otherwise(fields[0])
    fields[4] = F.when(kind == 23, F.lit("2001-02-31")).otherwise(fields[4])
    line = F.concat_ws("|", *fields)
    line = F.when(kind == 31, F.substring_index(line, "|", 5)).when(kind == 37, F.concat(line, F.lit("|more"))).otherwise(line)
    header = spark.createDataFrame([("|".join(readers.IDENTITY_ORG_COLUMNS),)], "value string")
    path = shared_path(spark, "orgs-bad")
    # One file, its header first; a real export has a header in each of its files.
    lines = header.select(F.lit(0).alias("n"), F.lit(0).cast("long").alias("id"), "value").unionByName(orgs.select(F.lit(1).alias("n"), "id", line.alias("value")))
    lines.repartition(1).sortWithinPartitions("n", "id").select("value").write.text(path)
    checked = quarantine.read_orgs_checked(spark, path, columns=readers.IDENTITY_ORG_COLUMNS, max_share=0.2)
    good = checked.orgs.select(F.lit("orgs").alias("reason"), F.lit(True).alias("kept"))
    return good.unionByName(checked.rejects.select("reason", "kept")).groupBy("reason", "kept").agg(F.count("*").alias("rows"))


def q_history_type_widening(spark, sf_dir):
    """Three runs of a history: the second has a column more and wider types, the
    third a column less."""
    base = FixtureTables(spark, sf_dir).raw("customer")
    path = shared_path(spark, "history-types")
    runs = [
        base.selectExpr("c_custkey AS id", "CAST(c_nationkey AS SMALLINT) AS nation", "CAST(c_acctbal AS DECIMAL(8,2)) AS balance", "c_name AS name"),
        base.selectExpr("c_custkey AS id", "CAST(c_nationkey AS BIGINT) * 10000000000 AS nation", "CAST(c_acctbal AS DECIMAL(20,4)) / CAST(8 AS DECIMAL(1,0)) AS balance", "c_name AS name", "c_mktsegment AS segment"),
        base.selectExpr("c_custkey AS id", "c_nationkey AS nation", "CAST(c_acctbal AS INT) AS balance", "c_mktsegment AS segment"),
    ]
    runs[1] = runs[1].withColumn("balance", F.col("balance").cast("decimal(20,4)"))
    for week, rows in enumerate(runs):
        writers.append_history(rows, path, RunConfig().run_ts + _dt.timedelta(days=7 * week))
    return readers.read_history(spark, path).selectExpr("org_id", "nation", "CAST(balance AS DOUBLE) AS balance", "name", "segment", "run_id")


def q_curve_distinct_merge(spark, sf_dir):
    """Distinct organisations and groups of each class over two runs, by merged
    sketches of the runs, against the exact counts."""
    path = shared_path(spark, "class-sketches")
    rows = []
    for df, ts in _two_runs(spark, sf_dir):
        run_id = ts.strftime("%Y%m%dT%H%M%S")
        changed = materialize(df.select("id", "econ_group", "curve"))
        distinct_sketch.append_sketches(distinct_sketch.class_sketches(changed, run_id), path)
        rows.append(changed)
    exact = rows[0].unionByName(rows[1]).groupBy("curve").agg(F.countDistinct("id").alias("orgs"), F.countDistinct("econ_group").alias("groups"))
    merged = distinct_sketch.merged_counts(spark.read.parquet(path)).selectExpr("curve AS c", "runs", "orgs AS o", "groups AS g")
    near = "abs({0} - {1}) <= 0.08 * {1} AS {2}"
    return exact.join(merged, F.col("curve") == F.col("c")).selectExpr(_big("curve"), _big("runs"), _big("orgs"), _big("groups"), near.format("o", "orgs", "orgs_near"), near.format("g", "groups", "groups_near"))


def q_date_coerce(spark, sf_dir):
    """Text dates parsed without failing: billing dates as 'yyyyMMdd' text
    (valid), stored first dates (null where missing) and market-segment text
    (not dates)."""
    t = FixtureTables(spark, sf_dir)
    texts = (
        O.billing_span(t.invoices)
        .selectExpr("'billing_first' AS source", "client_code AS key", "date_format(first_billed, 'yyyyMMdd') AS raw")
        .unionByName(
            t.orgs.selectExpr("'crm_first' AS source", "CAST(id AS STRING) AS key", "date_format(crm_first, 'yyyyMMdd') AS raw")
        )
        .unionByName(
            t.raw("customer").selectExpr("'segment' AS source", "CAST(c_custkey AS STRING) AS key", "c_mktsegment AS raw")
        )
    )
    return texts.select("source", "key", "raw", F.date_format(coerce_date("raw"), "yyyy-MM-dd").alias("parsed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "client_month_revenue": q_client_month_revenue,
    "client_billing_span": q_client_billing_span,
    "headcount_intervals": q_headcount_intervals,
    "org_code_explode": q_org_code_explode,
    "org_code_explode_outer": q_org_code_explode_outer,
    "client_group_join": q_client_group_join,
    "group_revenue": q_group_revenue,
    "group_revenue_total": q_group_revenue_total,
    "group_cumulative_revenue": q_group_cumulative_revenue,
    "abc_curve": q_abc_curve,
    "org_abc": q_org_abc,
    "org_billing_span": q_org_billing_span,
    "org_activity_status": q_org_activity_status,
    "group_status_rollup": q_group_status_rollup,
    "flag_billing_change": q_flag_billing_change,
    "flag_status_change": q_flag_status_change,
    "flag_curve_change": q_flag_curve_change,
    "flag_group_status_change": q_flag_group_status_change,
    "changed_orgs": q_changed_orgs,
    "curve_summary": q_curve_summary,
    "curve_movers": q_curve_movers,
    "update_outbox": q_update_outbox,
    "update_payload_json": q_update_payload_json,
    "month_calendar": q_month_calendar,
    "group_month_grid": q_group_month_grid,
    "active_headcount": q_active_headcount,
    "demand_mom": q_demand_mom,
    "mean_demand": q_mean_demand,
    "rdm_profile": q_rdm_profile,
    "recency_segment": q_recency_segment,
    "demand_segment": q_demand_segment,
    "delivery_report": q_delivery_report,
    "history_union": q_history_union,
    "history_append_roundtrip": q_history_append_roundtrip,
    "csv_pipe_roundtrip": q_csv_pipe_roundtrip,
    "status_movers": q_status_movers,
    "segment_file_roundtrip": q_segment_file_roundtrip,
    "http_file_roundtrip": q_http_file_roundtrip,
    "delivery_report_roundtrip": q_delivery_report_roundtrip,
    "date_coerce": q_date_coerce,
    "billing_state_two_runs": q_billing_state_two_runs,
    "headcount_sweep": q_headcount_sweep,
    "headcount_daily_runs": q_headcount_daily_runs,
    "exact_rounding": q_exact_rounding,
    "segment_intervals": q_segment_intervals,
    "snapshot_rejects_roundtrip": q_snapshot_rejects_roundtrip,
    "history_type_widening": q_history_type_widening,
    "curve_distinct_merge": q_curve_distinct_merge,
    "report_route": q_report_route,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def prepare(spark: SparkSession) -> None:
    """Session-side preparation every query relies on (shared folder)."""
    ensure_checkpoint_dir(spark)
