"""Properties of the distributed running sum and of the run outputs."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from clientcurve import operators as O

_settings = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def single_window(df, value, tiebreak):
    """The running sum in its plain form: one window over all rows, one task."""
    order = [F.col(value).desc(), F.col(tiebreak).asc()]
    run = F.sum(value).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("cum", run).withColumn("total", F.sum(value).over(Window.partitionBy()))


@_settings
@given(
    values=st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=60),
    parts=st.one_of(st.none(), st.integers(min_value=1, max_value=9)),
)
def test_prefix_sum_equals_global_window(spark, values, parts):
    # small value range -> many exact ties, including one value shared by most rows
    rows = [(f"g{i:03d}", Decimal(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "econ_group string, gross decimal(38,2)")
    got = {r["econ_group"]: (r["cum"], r["total"]) for r in O.running_sum(df, "gross", "econ_group", num_partitions=parts).collect()}
    want = {
        r["econ_group"]: (r["cum"], r["total"])
        for r in single_window(df, "gross", "econ_group").collect()
    }
    assert got == want


def test_prefix_sum_with_one_hot_value(spark):
    # a third of the rows share one value: the range partitioner must split it
    rows = [(f"h{i:05d}", Decimal(7)) for i in range(3000)] + [(f"g{i:05d}", Decimal(i % 97)) for i in range(6000)]
    df = spark.createDataFrame(rows, "econ_group string, gross decimal(38,2)")
    got = O.running_sum(df, "gross", "econ_group", num_partitions=8)
    want = single_window(df, "gross", "econ_group")
    assert got.select("econ_group", "cum").exceptAll(want.select("econ_group", "cum")).count() == 0
    assert got.count() == 9000


def test_curve_is_monotone_and_last_share_is_one(spark):
    rows = [(f"g{i:04d}", Decimal(1 + (i * 37) % 500)) for i in range(400)]
    df = spark.createDataFrame(rows, "econ_group string, gross decimal(38,2)")
    res = sorted(
        (tuple(r) for r in O.abc_classify(df, num_partitions=5).select("gross", "econ_group", "cum_share", "curve").collect()),
        key=lambda r: (-r[0], r[1]),
    )
    shares = [r[2] for r in res]
    curves = [r[3] for r in res]
    assert shares == sorted(shares)
    assert abs(shares[-1] - 1.0) < 1e-12
    assert curves == sorted(curves)


def test_revenue_conserved_with_one_to_one_code_map(spark, invoices_df, orgs_df):
    import datetime as dt

    inv = invoices_df([(str(c), dt.date(2024, 5, 1 + c % 20), Decimal(c), "F", 1) for c in range(1, 40)])
    orgs = orgs_df([{"id": c, "codes": str(c), "econ_group": f"G{c % 5}"} for c in range(1, 40)])
    rev = O.client_month_revenue(inv, dt.date(2024, 6, 30))
    grp = O.group_revenue(rev, O.explode_codes(orgs))
    assert sum(r["gross"] for r in grp.collect()) == sum(Decimal(c) for c in range(1, 40))


def test_sums_beyond_64_bits(spark):
    rows = [("a", Decimal("90000000000000000.00")), ("b", Decimal("90000000000000000.00"))]
    df = spark.createDataFrame(rows, "econ_group string, gross decimal(38,2)")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got = {r["econ_group"]: (r["cum"], r["total"]) for r in O.running_sum(df, "gross", "econ_group").collect()}
            assert got == {"a": (Decimal("90000000000000000"), Decimal("180000000000000000")), "b": (Decimal("180000000000000000"),) * 2}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_segments_of_any_number(spark):
    dim = spark.createDataFrame([(i, f"S{i}", i, i) for i in range(-5000, 5002)], "r_id int, segment string, lo int, hi int")
    df = spark.createDataFrame([(-5000,), (-1,), (0,), (7,), (5001,), (5002,), (None,)], "v int")
    got = {r["v"]: r["seg"] for r in O.segment(df, dim, "v", "seg").collect()}
    assert got == {-5000: "S-5000", -1: "S-1", 0: "S0", 7: "S7", 5001: "S5001", 5002: None, None: None}


def test_organisations_without_group_bypass_the_group_joins(spark, orgs_df):
    orgs = orgs_df([{"id": i, "econ_group": None if i % 3 == 0 else f"G{i % 4}"} for i in range(60)])
    abc = spark.createDataFrame([("G1", 27, 654)], "econ_group string, curve int, group_status int")
    out = O.org_abc(orgs, abc)
    assert out.count() == 60 and out.where("econ_group IS NULL AND curve = 694 AND group_status = 700").count() == 20
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(econ_group" in plan and "isnull(econ_group" in plan
