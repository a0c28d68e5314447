"""The scheduled run as a spark-submit job.

    spark-submit -m clientcurve.plans.job \
        --invoices <parquet path> --employees <parquet path> \
        --orgs <delimited snapshot path> --out <shared output folder> \
        [--as-of YYYY-MM-DD] [--segments <segment JSON>] \
        [--delivery-log <parquet path> --http-codes <file>] \
        [--invoice-log <path> --billing-state <path> --loads <id,id>]

Invoices and employees are read as Parquet in the model's column names, or, with
``--jdbc-url``, as tables of the source database in its own column names.
The run date defaults to today. Outputs go to <out>/run_date=<date>, so re-running
a date rewrites only that run; the history, the outbox and the delivery report are
tables of all runs, partitioned by run. With ``--billing-state`` the billing facts come
from a state that the given loads of the invoice log are merged into, and ``--invoices``
is not read. Rows of the snapshot that cannot be read are an output of the run.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..config import RunConfig
from ..operators import billing_state
from ..sources import dims, quarantine, readers, slices
from .billing_run import BillingRun


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="client-billing run")
    p.add_argument("--invoices", help="Parquet path, or table name with --jdbc-url")
    p.add_argument("--employees", required=True, help="Parquet path, or table name with --jdbc-url")
    p.add_argument("--jdbc-url", help="read invoices and employees from this database, in its column names")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="reader option, e.g. user=...; may repeat")
    p.add_argument("--jdbc-balanced-slices", type=int, default=16, help="parallel reads of a table, balanced by its rows a month")
    p.add_argument("--jdbc-slices", type=int, help="instead: parallel reads by equal steps of the issue or admission date, without counting first")
    p.add_argument("--invoice-log", help="log of invoice loads (operators.billing_state)")
    p.add_argument("--billing-state", help="where the state of that log is published")
    p.add_argument("--loads", default="", help="loads of the log to merge, comma-separated")
    p.add_argument("--max-reject-share", type=float, default=quarantine.MAX_SHARE, help="share of snapshot rows that may be set aside")
    p.add_argument("--orgs", required=True, help="CRM snapshot, pipe-delimited with header")
    p.add_argument("--out", required=True, help="shared output folder of all runs")
    p.add_argument("--as-of", type=_dt.date.fromisoformat, default=_dt.date.today())
    p.add_argument("--segments", help="segment dimensions JSON (defaults to the built-in ones)")
    p.add_argument("--http-codes", help="HTTP-code dimension file (needed with --delivery-log)")
    p.add_argument("--delivery-log", help="delivery log table (org_id, http_code, run_date)")
    p.add_argument("--history", help="history table of all runs (defaults to <out>/history)")
    p.add_argument("--orgs-sep", default="|")
    p.add_argument("--month-aligned", action="store_true", help="whole months, up to the month before the run")
    p.add_argument("--billing-until-as-of", action="store_true", help="no billing date after the run date")
    a = p.parse_args(argv)
    if a.delivery_log and not a.http_codes:
        p.error("--delivery-log needs --http-codes")
    if bool(a.invoice_log) != bool(a.billing_state):
        p.error("--invoice-log and --billing-state go together")
    if not a.invoices and not a.invoice_log:
        p.error("--invoices or --invoice-log is needed")
    return a


def read_facts(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """Invoices and employees in the model's columns, from Parquet or a database.
    A database table is read in slices of about equal row counts."""
    if a.invoice_log:
        invoices = billing_state.newest_versions(billing_state.read_log(spark, a.invoice_log)).drop("bucket")
    elif not a.jdbc_url:
        invoices = spark.read.parquet(a.invoices)
    if not a.jdbc_url:
        return invoices, spark.read.parquet(a.employees)
    options = dict(o.split("=", 1) for o in a.jdbc_option)

    def table(name: str, column: str, years: int, spread: str | None = None) -> DataFrame:
        if not a.jdbc_slices:
            return slices.jdbc_balanced(spark, a.jdbc_url, name, column, a.jdbc_balanced_slices, options, spread)
        # Rows before the first step's bound go to the first slice, none is lost.
        first = a.as_of.replace(year=a.as_of.year - years, day=1)
        return readers.jdbc_table(spark, a.jdbc_url, name, options, column, f"{first} 00:00:00", f"{a.as_of} 00:00:00", a.jdbc_slices)

    if not a.invoice_log:
        invoices = readers.invoices_from_source(table(a.invoices, "DataEmissao", 5, "NroNfe"))
    return invoices, readers.employees_from_source(table(a.employees, "DataAdmissao", 20))


def main(argv=None) -> dict:
    a = parse_args(argv)
    spark = SparkSession.builder.appName(f"clientcurve-{a.as_of}").getOrCreate()
    invoices, employees = read_facts(spark, a)
    snapshot = quarantine.read_orgs_checked(spark, a.orgs, sep=a.orgs_sep, max_share=a.max_reject_share)
    if a.segments:
        dim_recency, dim_demand = readers.read_segment_dims(spark, a.segments)
    else:
        dim_recency, dim_demand = dims.dim_recency(spark), dims.dim_demand(spark)
    http_codes = readers.read_http_codes(spark, a.http_codes) if a.http_codes else None
    log = spark.read.parquet(a.delivery_log) if a.delivery_log else None
    cfg = RunConfig(as_of=a.as_of, month_aligned=a.month_aligned, billing_until_as_of=a.billing_until_as_of)
    facts = None
    if a.billing_state:
        version = billing_state.update_state(spark, a.invoice_log, a.billing_state, [x for x in a.loads.split(",") if x], a.as_of)
        facts = billing_state.state_facts(version, spark, cfg.window_end, (cfg.window_end - cfg.window_start).days)
    run = BillingRun(invoices, employees, snapshot.orgs, cfg, delivery_log=log, facts=facts)
    return run.write_outputs(a.out, dim_recency=dim_recency, dim_demand=dim_demand, http_codes=http_codes, history=a.history, rejects=snapshot.rejects)


if __name__ == "__main__":
    main()
