"""End to end on the smallest driver tables: the scheduled job writes every
output, the flagship query returns the documented counts, and every
registered query agrees with its SQL oracle."""

import pytest

import __spark_entry__ as E
from clientcurve import sources
from clientcurve.plans.registry import QUERIES, run_for
from clientcurve.session import shared_path

from .conftest import SF_SMALL
from .oracle_compare import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 138  # FIXTURES.md §2 at sf0.001
    assert "group_status_changed" in df.columns


def test_counts_match_fixture_table(spark):
    r = run_for(spark, SF_SMALL)
    curves = {row["curve"]: row["n"] for row in r.abc.groupBy("curve").count().withColumnRenamed("count", "n").collect()}
    assert curves == {27: 21, 28: 9, 29: 8}
    roll = {row["group_status"]: row["n"] for row in r.org_rollup.groupBy("group_status").count().withColumnRenamed("count", "n").collect()}
    assert roll == {654: 134, 700: 5, None: 11}


def test_write_outputs(spark):
    r = run_for(spark, SF_SMALL)
    out = shared_path(spark, "run")
    paths = r.write_outputs(
        out,
        dim_recency=sources.dim_recency(spark),
        dim_demand=sources.dim_demand(spark),
        http_codes=sources.http_codes(spark),
    )
    assert spark.read.parquet(paths["changed_orgs"]).count() == 138
    assert spark.read.parquet(paths["history"]).count() == 138
    assert spark.read.parquet(paths["update_outbox"]).count() == 138
    prof = spark.read.parquet(paths["rdm_profile"])
    assert {"recency_segment", "demand_segment"} <= set(prof.columns)
    # the delivery report holds the run's own date
    log = r.delivery_log.where(f"run_date = DATE '{r.cfg.as_of}'").count()
    assert _rows(spark, paths["delivery_report"]) == log


def _rows(spark, path):
    return spark.read.schema("org_id long").parquet(path).count()


def test_two_dates_share_one_output(spark):
    """Two runs, then the older again: both runs' tables stay, the history adds up."""
    import datetime as dt

    from clientcurve import RunConfig
    from clientcurve.plans.billing_run import BillingRun
    from clientcurve.sources.fixtures import FixtureTables

    t = FixtureTables(spark, SF_SMALL)
    out = shared_path(spark, "runs")

    def once(day):
        run = BillingRun(t.invoices, t.employees, t.orgs, RunConfig(as_of=day))
        return run.write_outputs(out, history=f"{out}/all-history")

    new, old = once(dt.date(2001, 8, 1)), once(dt.date(2001, 1, 1))
    n, o = (spark.read.parquet(p["changed_orgs"]).count() for p in (new, old))
    assert n == 138 and new["changed_orgs"] != old["changed_orgs"]
    once(dt.date(2001, 1, 1))
    assert spark.read.parquet(new["changed_orgs"]).count() == n and spark.read.parquet(old["changed_orgs"]).count() == o
    assert spark.read.parquet(f"{out}/all-history").count() == n + o



def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_spark_submit_job(spark, tmp_path):
    """The job entry point on files laid out as in production: model-named
    Parquet tables and the CRM snapshot as a pipe file with its own header."""
    from clientcurve.plans import job
    from clientcurve.sources import readers
    from clientcurve.sources.fixtures import FixtureTables
    from clientcurve.sinks import writers

    t = FixtureTables(spark, SF_SMALL)
    base = shared_path(spark, "job")
    t.invoices.write.parquet(f"{base}/invoices")
    t.employees.write.parquet(f"{base}/employees")
    # some attempts on the run's date, the others on other dates
    log = t.delivery_log.selectExpr("org_id", "http_code", "if(http_code = 404, DATE '2001-08-01', run_date) AS run_date")
    log.write.parquet(f"{base}/log")
    crm = t.orgs.select([t.orgs[v].alias(k) for k, v in readers.ORG_SNAPSHOT_COLUMNS.items()])
    writers.write_delimited(crm, f"{base}/orgs", sep="|")
    import json

    from clientcurve import config as C

    seg = tmp_path / "segments.json"
    seg.write_text(
        json.dumps(
            {
                "DimRecencia": [dict(zip(["R_ID", "R_Segmento", "minimo", "maximo"], r)) for r in C.RECENCY_SEGMENTS],
                "DimDemanda": [dict(zip(["D_ID", "D_Segmento", "minimo", "maximo"], r)) for r in C.DEMAND_SEGMENTS],
            },
            indent=2,
        ),
        encoding="utf-8",
    )
    codes = tmp_path / "codes.csv"
    codes.write_bytes("\ufeffCode;Descr;Link;Descr\n200;OK;https://x/200;ok\n404;Not Found;https://x/404;\n".encode("utf-8"))
    paths = job.main(
        [
            "--segments", str(seg),
            "--http-codes", str(codes),
            "--invoices", f"{base}/invoices",
            "--employees", f"{base}/employees",
            "--orgs", f"{base}/orgs",
            "--delivery-log", f"{base}/log",
            "--out", f"{base}/out",
            "--as-of", "2001-08-01",
        ]
    )
    assert spark.read.parquet(paths["changed_orgs"]).count() == 138
    report = spark.read.parquet(paths["delivery_report"])
    assert report.count() == log.where("run_date = DATE '2001-08-01'").count() > 0
    assert {r["description"] for r in report.where("http_code = 404").select("description").distinct().collect()} == {"Not Found"}
    prof = spark.read.parquet(paths["rdm_profile"])
    assert prof.where("recency_segment IS NOT NULL").count() > 0


def test_outbox_has_exactly_the_changed_ids_and_rollup_is_constant(spark):
    r = run_for(spark, "/root/testdata/sf0.01")
    changed = {row["id"] for row in r.changed.select("id").collect()}
    outbox = [row["id"] for row in r.outbox.select("id").collect()]
    assert len(outbox) == len(set(outbox)) and set(outbox) == changed
    per_group = r.org_rollup.where("econ_group IS NOT NULL").groupBy("econ_group").agg(
        {"group_status": "count"}
    )
    distinct = r.org_rollup.where("econ_group IS NOT NULL").select("econ_group", "group_status").distinct()
    assert distinct.count() == per_group.count()


def test_job_reads_database_tables_in_slices(spark, monkeypatch):
    """Plan level only: the database reader is replaced by rows in the source's
    columns, and what it is asked for is looked at."""
    import datetime as dt
    from decimal import Decimal

    from clientcurve.plans import job
    from clientcurve.sources import readers

    asked = []
    tables = {
        "dbo.Notas": spark.createDataFrame(
            [(7, dt.datetime(2024, 3, 1, 5), Decimal("1.50"), "F", 3)], "CodigoCliente int, DataEmissao timestamp, ValorBruto decimal(10,2), Status string, NroNfe int"
        ),
        "dbo.Func": spark.createDataFrame([(7, 9, dt.datetime(2020, 1, 2), None)], "CodigoCliente int, CodigoFuncionario int, DataAdmissao timestamp, DataDemissao timestamp"),
    }

    def fake(session, url, table, properties=None, column=None, low=None, high=None, slices=None):
        asked.append((url, table, properties, column, low, high, slices))
        return tables[table]

    monkeypatch.setattr(readers, "jdbc_table", fake)
    base = ["--invoices", "dbo.Notas", "--employees", "dbo.Func", "--orgs", "x", "--out", "y", "--as-of", "2024-06-30"]
    a = job.parse_args([*base, "--jdbc-url", "jdbc:sqlserver://h", "--jdbc-option", "user=u", "--jdbc-slices", "4"])
    invoices, employees = job.read_facts(spark, a)
    assert [tuple(r) for r in invoices.collect()] == [("7", dt.date(2024, 3, 1), Decimal("1.50"), "F", 3)]
    assert [tuple(r) for r in employees.collect()] == [("7", "9", dt.date(2020, 1, 2), None)]
    assert asked[0] == ("jdbc:sqlserver://h", "dbo.Notas", {"user": "u"}, "DataEmissao", "2019-06-01 00:00:00", "2024-06-30 00:00:00", 4)
    assert asked[1][1:4] == ("dbo.Func", {"user": "u"}, "DataAdmissao")
