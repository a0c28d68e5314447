"""Snapshot rejects, history of changing types, balanced database slices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientcurve.session import shared_path
from clientcurve.sinks import history, writers
from clientcurve.sources import quarantine, readers, slices

HEADER = "id|codes|econ_group|crm_curve|crm_first|crm_last|crm_status|crm_group_status"


def snapshot(spark, files):
    path = shared_path(spark, "snapshot")
    for i, lines in enumerate(files):
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def read(spark, path, **options):
    return quarantine.read_orgs_checked(spark, path, columns=readers.IDENTITY_ORG_COLUMNS, **options)


def test_bad_rows_are_set_aside(spark):
    good = [f"{i}|{i}.{i + 1}|G{i % 3}|27|2024-01-0{i % 9 + 1}||171|654" for i in range(40)]
    bad = ["x|y|z", "1|2|3|4|5|6|7|8|9", "abc|1|G|27|||171|654", "|1|G|27|||171|654", "50|1|G|twenty|2024-02-30|2024-01-01 00:00:00|171.0|654", '51|"a|b"|G||||| ']
    path = snapshot(spark, [[HEADER, *good[:20], *bad], [HEADER, *good[20:]]])
    got = read(spark, path, max_share=0.2)
    assert (got.rows, got.rejected) == (46, 4)
    orgs = {r["id"]: r for r in got.orgs.collect()}
    assert set(orgs) == {*range(40), 50, 51}
    assert orgs[51]["codes"] == "a|b" and orgs[50]["crm_last"] == dt.date(2024, 1, 1) and orgs[50]["crm_status"] == 171
    found = {(r["reason"], r["field"], r["value"], r["kept"]) for r in got.rejects.collect()}
    assert found == {("fields", None, None, False), ("id", "id", "abc", False), ("id", "id", None, False), ("number", "crm_curve", "twenty", True), ("date", "crm_first", "2024-02-30", True)}
    torn = [r["record"] for r in got.rejects.where("reason = 'fields'").collect()]
    assert sorted(torn) == sorted(bad[:2])
    assert got.rejects.where("file IS NULL").count() == 0
    plain = readers.read_orgs_snapshot(spark, path, columns=readers.IDENTITY_ORG_COLUMNS)
    assert plain.where("id IS NULL").count() >= 3  # where the plain reader leaves them


def test_a_wrong_file_is_refused(spark):
    path = snapshot(spark, [[HEADER, "1|2|3|27|||171|654", "torn"]])
    with pytest.raises(quarantine.TooManyRejects, match="1 of 2 rows"):
        read(spark, path)
    other = snapshot(spark, [[HEADER, "1|2|3|27|||171|654"], [HEADER.replace("codes", "other"), "1|2|3|27|||171|654"]])
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, other)
    empty = read(spark, snapshot(spark, [[HEADER]]))
    assert (empty.rows, empty.rejected, empty.orgs.count()) == (0, 0, 0)


def test_a_header_without_a_column_is_refused(spark):
    """Whichever of the files is read first."""
    path = snapshot(spark, [[HEADER.replace("codes", "other"), "1|2|3|27|||171|654"]])
    with pytest.raises(ValueError, match="header of .* lacks codes"):
        read(spark, path)


# ------------------------------------------------------------------ history
def test_history_over_changed_types(spark, mk):
    path = shared_path(spark, "history")
    runs = [
        mk([(1, 5, "a", None)], "id long, n int, name string, gone date"),
        mk([(1, 2**40, "b", 1.5)], "id long, n long, name string, more float"),
        mk([(2, None, 2.25)], "id long, n short, more double"),
    ]
    runs[0] = runs[0].withColumn("money", F.lit("12.34").cast("decimal(8,2)"))
    runs[1] = runs[1].withColumn("money", F.lit("123456789.1234").cast("decimal(20,4)"))
    for i, rows in enumerate(runs):
        writers.append_history(rows, path, dt.datetime(2024, 1, 1 + i))
    h = readers.read_history(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in h.schema.fields}
    assert kinds["n"] == "bigint" and kinds["money"] == "decimal(20,4)" and kinds["more"] == "double"
    got = {r["run_id"]: r for r in h.collect()}
    assert [got[k]["n"] for k in sorted(got)] == [5, 2**40, None]
    assert [str(got[k]["money"]) for k in sorted(got)] == ["12.3400", "123456789.1234", "None"]
    assert [got[k]["name"] for k in sorted(got)] == ["a", "b", None] and got["20240103T000000"]["more"] == 2.25
    # A run appended again, in another type, replaces its schema with its rows.
    writers.append_history(mk([(9, 7)], "id long, n int"), path, dt.datetime(2024, 1, 2))
    assert readers.read_history(spark, path).where("run_id = '20240102T000000'").first()["n"] == 7
    # Runs from before there was a register are read by their files.
    old = writers.stamp_run(mk([(4, 3)], "id long, n short"), dt.datetime(2023, 1, 1))
    old.write.mode("append").partitionBy("run_id").parquet(path)
    assert {r["run_id"]: r["n"] for r in readers.read_history(spark, path).collect()}["20230101T000000"] == 3
    assert spark.read.parquet(path).count() == 4  # the register is no part of the table


def test_types_without_a_common_one(spark, mk):
    path = shared_path(spark, "history")
    writers.append_history(mk([(1, 5)], "id long, n int"), path, dt.datetime(2024, 1, 1))
    writers.append_history(mk([(1, "x")], "id long, n string"), path, dt.datetime(2024, 1, 2))
    with pytest.raises(history.NoCommonType, match="'n' is int in some runs and string"):
        readers.read_history(spark, path)


def test_wider_types():
    d = T.DecimalType
    cases = [
        (T.IntegerType(), T.LongType(), T.LongType()), (T.ByteType(), T.ShortType(), T.ShortType()), (d(8, 2), d(6, 4), d(10, 4)), (T.IntegerType(), d(8, 2), d(12, 2)), (T.LongType(), d(38, 20), None),
        (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.IntegerType(), T.FloatType(), T.DoubleType()), (T.LongType(), T.DoubleType(), None), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.NullType(), T.StringType(), T.StringType()), (T.StringType(), T.IntegerType(), None), (d(38, 0), d(38, 10), None),
    ]
    for a, b, out in cases:
        assert history.wider(a, b) == out and history.wider(b, a) == out


# ------------------------------------------------------------------ slices
def check_slices(spark, rows, histogram, n, spread=None):
    predicates = slices.month_slices("d", histogram, n, spread)
    df = spark.createDataFrame(rows, "d date, k long")
    hits = F.expr(" + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in predicates))
    assert df.where(hits != 1).count() == 0  # each row in exactly one slice
    return [df.where(p).count() for p in predicates]


def histogram_of(rows):
    out = {}
    for d, _ in rows:
        k = d.year * 100 + d.month if d else None
        out[k] = out.get(k, 0) + 1
    return list(out.items())


def test_slices_are_disjoint_complete_and_balanced(spark):
    rows = [(dt.date(1990 + i % 30, 1 + i % 12, 1 + i % 28), i) for i in range(3000)]
    rows += [(dt.date(1950, 1, 1), i) for i in range(40)] + [(None, i) for i in range(100)]
    sizes = check_slices(spark, rows, histogram_of(rows), 8)
    assert 8 <= len(sizes) <= 12 and max(sizes) <= 2 * 3140 / 8
    late = rows + [(dt.date(2030, 1, 1), 1), (dt.date(1900, 1, 1), 2), (None, None)]  # after the count
    check_slices(spark, late, histogram_of(rows), 8)


def test_a_hot_month_and_many_nulls_are_divided(spark):
    rows = [(dt.date(2020, 5, 1 + i % 28), i - 500) for i in range(2000)] + [(None, i) for i in range(1500)]
    rows += [(dt.date(2021, 1, 1), i) for i in range(200)] + [(dt.date(2020, 5, 3), None), (None, None)]
    sizes = check_slices(spark, rows, histogram_of(rows), 10, "k")
    assert max(sizes) <= 2 * len(rows) / 10
    whole = check_slices(spark, rows, histogram_of(rows), 10)
    assert max(whole) >= 2000


def test_slices_of_an_empty_table(spark):
    assert check_slices(spark, [(dt.date(2020, 1, 1), 1), (None, 2)], [], 4) == [1, 1]
    assert check_slices(spark, [(dt.date(2020, 1, 1), 1), (None, 2)], [(None, 3)], 1) == [1, 1]


def test_job_counts_months_first(spark, monkeypatch):
    from clientcurve.plans import job

    asked = []

    def fake(spark_, url, table, column, n, options=None, spread=None):
        asked.append((url, table, column, n, options, spread))
        source = readers.INVOICE_COLUMNS if "Nroes" not in table and column == "DataEmissao" else readers.EMPLOYEE_COLUMNS
        return spark_.createDataFrame([], ", ".join(f"{c} string" for c in source))

    monkeypatch.setattr(slices, "jdbc_balanced", fake)
    a = job.parse_args(["--invoices", "dbo.N", "--employees", "dbo.F", "--orgs", "o", "--out", "x", "--jdbc-url", "jdbc:sqlserver://h", "--as-of", "2024-06-30"])
    job.read_facts(spark, a)
    assert asked == [("jdbc:sqlserver://h", "dbo.N", "DataEmissao", 16, {}, "NroNfe"), ("jdbc:sqlserver://h", "dbo.F", "DataAdmissao", 16, {}, None)]
    assert slices.month_histogram_sql("t", "d") == "SELECT YEAR(d) * 100 + MONTH(d) AS k, COUNT(*) AS n FROM t GROUP BY YEAR(d) * 100 + MONTH(d)"
