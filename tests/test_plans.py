"""Physical-plan checks: no Python UDFs, no single-partition window over
data rows, filters and column pruning reaching the Parquet scan."""

import datetime as dt
import re
from decimal import Decimal

import pytest

import __spark_entry__ as E
from clientcurve import operators as O
from clientcurve.session import shared_path

from .conftest import SF_SMALL

PLAN_QUERIES = ["abc_curve", "changed_orgs", "active_headcount", "demand_mom", "rdm_profile", "update_payload_json"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_udf_and_no_global_window(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only the per-partition offsets table (one row per range partition) may be gathered
            below = "\n".join(lines[i + 1 : i + 3])
            assert "_rs_part" in below, f"single-partition exchange over data rows in {name}:\n{plan}"


def test_revenue_filters_and_columns_reach_the_scan(spark, invoices_df):
    inv = invoices_df([("1", dt.date(2024, 6, 1), Decimal("1.00"), "F", 1), ("2", dt.date(2020, 1, 1), Decimal("2.00"), "C", 0)])
    path = shared_path(spark, "inv-plan")
    inv.write.parquet(path)
    df = O.client_month_revenue(spark.read.parquet(path), dt.date(2024, 6, 30))
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    read_schema = re.search(r"ReadSchema: (struct<[^\n]*>)", text).group(1)
    assert read_schema == "struct<client_code:string,issue_date:date,gross:decimal(18,2),status:string,nfe_no:bigint>"
    assert "GreaterThanOrEqual(issue_date,2023-07-01)" in pushed
    assert "LessThanOrEqual(issue_date,2024-06-30)" in pushed
    assert "Not(EqualTo(status,C))" in pushed
    assert "Not(EqualTo(nfe_no,0))" in pushed
    assert df.count() == 1


def test_running_sum_has_no_single_partition_over_rows(spark):
    rows = [(f"g{i}", Decimal(i % 13)) for i in range(500)]
    df = spark.createDataFrame(rows, "econ_group string, gross decimal(38,2)")
    plan = _plan(O.running_sum(df, "gross", "econ_group", num_partitions=4))
    assert "Exchange SinglePartition" not in plan.split("BroadcastExchange")[0]
    for line in plan.splitlines():
        if "Window [" in line and "_rs_local" in line:
            pytest.fail("per-row window must run on the checkpointed range partitions")


def test_org_frame_reads_invoice_history_once(spark):
    """Once the per-client reduction and the pre-roll-up frame are
    materialised, computing the flags scans no source table again."""
    from clientcurve.plans.registry import run_for

    r = run_for(spark, SF_SMALL)
    plan = _plan(r.changed)
    assert "FileScan" not in plan, plan
    assert "Scan ExistingRDD" in plan


def test_code_join_has_no_outer_join(spark):
    """The client/code left join is planned as inner + anti join, so a hot
    code on the code-map side stays splittable by AQE."""
    from clientcurve.plans.registry import run_for

    r = run_for(spark, SF_SMALL)
    plan = _plan(O.client_group_join(r.client_rev, r.code_map))
    assert "LeftOuter" not in plan and "RightOuter" not in plan
    assert "LeftAnti" in plan


def test_materialize_parquet_option_round_trips(spark):
    from clientcurve.session import materialize

    df = spark.createDataFrame([(1, Decimal("1.25"), dt.date(2024, 1, 2))], "id long, v decimal(18,2), d date")
    back = materialize(df, fmt="parquet")
    assert "FileScan parquet" in _plan(back)
    assert [tuple(r) for r in back.collect()] == [(1, Decimal("1.25"), dt.date(2024, 1, 2))]


def test_window_reaches_the_orders_scan_through_the_binding(spark):
    from clientcurve.plans.registry import run_for

    df = run_for(spark, SF_SMALL).client_rev
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01T00:00)" in pushed
    assert "LessThan(o_orderdate,2001-08-02T00:00)" in pushed
    assert "o_orderpriority" not in re.search(r"ReadSchema: (struct<[^\n]*>)", text).group(1)


def _scan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_window_queries_read_the_window_only(spark):
    """Before anything is stored: the date bounds of the revenue window, and of
    the employees' intervals, are pushed into the scan of the orders."""
    from clientcurve.plans.registry import run_for

    r = run_for(spark, SF_SMALL)
    text = _scan(r.group_rev)
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01" in text and "LessThan(o_orderdate,2001-08-02" in text
    assert "LessThan(o_orderdate,2001-09-01" in _scan(r.window_intervals)
    assert "facts" not in r.__dict__ and "group_facts" not in r.__dict__


def test_date_queries_need_no_revenue(spark):
    from clientcurve.plans.registry import run_for

    r = run_for(spark, SF_SMALL)
    assert "o_totalprice" not in _scan(r.org_dated)
    assert not {"facts", "group_facts", "abc"} & set(r.__dict__)
