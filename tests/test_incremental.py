"""Billing state, sweep line, range lookup, rounding, sketches."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from clientcurve.functions.exact import round_exact
from clientcurve.operators import billing_state as B
from clientcurve.operators import client_facts, active_headcount, distinct_sketch, ranges, sweep
from clientcurve.session import shared_path
from clientcurve.sinks import publish
from clientcurve.sources.fixtures import FixtureTables

from .conftest import SF_SMALL

LOG = "invoice_id long, client_code string, issue_date date, gross decimal(18,2), status string, nfe_no long, revised boolean"
AS_OF = dt.date(2024, 6, 30)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def load(spark, log, name, rows):
    B.append_load(spark.createDataFrame(rows, LOG), log, name, buckets=4)


def facts(spark, rows, as_of=AS_OF):
    """The frame of one full run over the invoices as they stand at the end."""
    last = {}
    for r in rows:
        last[r[0], r[1]] = r
    return rows_of(client_facts(spark.createDataFrame([r[1:6] for r in last.values()], "client_code string, issue_date date, gross decimal(18,2), status string, nfe_no long"), as_of))


def D(m, d, y=2024):
    return dt.date(y, m, d)


def test_two_loads_equal_one_full_run(spark):
    from decimal import Decimal

    log, root = shared_path(spark, "log"), shared_path(spark, "state")
    first = [(i, f"c{i % 7}", D(1 + i % 6, 1 + i % 28, 2021 + i % 4), Decimal(i) / 4, "A", i % 5, False) for i in range(400)]
    first += [(1000, "once", D(3, 1, 2019), Decimal(5), "A", 1, False), (1001, None, D(3, 2), Decimal(5), "A", 1, False), (1002, "none", D(3, 2), Decimal(5), None, 1, False)]
    second = [(500 + i, f"c{i % 3}", D(6, 1 + i % 28), Decimal(i), "A", 1, False) for i in range(50)]
    second += [(0, "c0", D(1, 1, 2021), Decimal(0), "C", 0, True)]  # a late cancellation of the first date
    second += [(1000, "once", D(3, 1, 2019), Decimal(5), "C", 1, True)]  # a client without any invoice left
    second += [(8, "c1", D(2, 2), Decimal("99.75"), "A", 3, True)]  # a correction
    second += [(2000, "new", D(6, 30), None, "A", 1, False), (2001, "new", D(5, 30), Decimal(1), "C", 1, False)]
    load(spark, log, "0001", first)
    v1 = B.update_state(spark, log, root, ["0001"], AS_OF)
    assert rows_of(B.state_facts(v1, spark, AS_OF)) == facts(spark, first)
    load(spark, log, "0002", second)
    v2 = B.update_state(spark, log, root, ["0001", "0002"], AS_OF)
    assert v2.note["loads"] == "0001,0002"
    assert rows_of(B.state_facts(v2, spark, AS_OF)) == facts(spark, first + second)
    # A repeated run, a load by load run and an empty load change nothing.
    assert B.update_state(spark, log, root, ["0002"], AS_OF).folder == v2.folder
    load(spark, log, "0003", [])
    v3 = B.update_state(spark, log, root, ["0003"], AS_OF)
    assert rows_of(B.state_facts(v3, spark, AS_OF)) == facts(spark, first + second)
    # Days that left the horizon are dropped, those of the window are not.
    v4 = B.update_state(spark, log, root, ["0004"], AS_OF, keep_days=365)
    assert v4.read(spark, "days").agg(F.min("issue_date")).first()[0] >= AS_OF - dt.timedelta(days=365)
    assert rows_of(B.state_facts(v4, spark, AS_OF)) == facts(spark, first + second)


def test_second_run_reads_only_new_partitions(spark):
    """The first load is made unreadable: a second run without cancellations does not
    miss it, one with a cancellation reads the bucket of the touched client only."""
    import glob
    from decimal import Decimal

    log, root = shared_path(spark, "log"), shared_path(spark, "state")
    first = [(i, f"c{i}", D(1, 5), Decimal(2), "A", 1, False) for i in range(40)]
    load(spark, log, "0001", first)
    B.update_state(spark, log, root, ["0001"], AS_OF)
    fresh = B.read_log(spark, log).where(F.col("load").isin(["0002"]))
    assert "PartitionFilters: [isnotnull(load" in fresh._jdf.queryExecution().executedPlan().toString()

    buckets = {r["client_code"]: r["bucket"] for r in B.read_log(spark, log).select("client_code", "bucket").collect()}
    for name in glob.glob(f"{log.removeprefix('file:')}/load=0001/*/*.parquet"):
        if f"bucket={buckets['c3']}/" not in name:
            with open(name, "wb") as f:
                f.write(b"nothing to read here")
    second = [(100, "c5", D(6, 5), Decimal(3), "A", 1, False), (101, "c9", D(1, 1), Decimal(3), "A", 0, False)]
    load(spark, log, "0002", second)
    v = B.update_state(spark, log, root, ["0002"], AS_OF)
    assert rows_of(B.state_facts(v, spark, AS_OF)) == facts(spark, first + second)
    third = [(3, "c3", D(1, 5), Decimal(2), "C", 1, True)]
    load(spark, log, "0003", third)
    v = B.update_state(spark, log, root, ["0003"], AS_OF)
    assert rows_of(B.state_facts(v, spark, AS_OF)) == facts(spark, first + second + third)


def test_a_run_from_the_state_equals_one_from_the_invoices(spark):
    from clientcurve import RunConfig
    from clientcurve.plans.billing_run import BillingRun

    log, root, cfg = shared_path(spark, "log"), shared_path(spark, "state"), RunConfig()
    t = FixtureTables(spark, SF_SMALL)
    for name, rows in t.invoice_loads(cfg.as_of - dt.timedelta(days=40)):
        B.append_load(rows, log, name, 4)
        version = B.update_state(spark, log, root, [name], cfg.as_of)
    kept = B.state_facts(version, spark, cfg.as_of)
    nothing = t.invoices.where("false")  # never read
    a = BillingRun(nothing, t.employees, t.orgs, cfg, facts=kept)
    b = BillingRun(t.invoices, t.employees, t.orgs, cfg)
    assert rows_of(a.changed) == rows_of(b.changed)
    assert rows_of(a.profile) == rows_of(b.profile)


# ------------------------------------------------------------------ publishing
def test_readers_see_the_last_complete_version(spark):
    root = shared_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root, "a")
    one = publish.publish({"a": spark.range(3), "b": spark.range(4)}, root, {"run": "1"})
    bad = spark.range(5).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish.publish({"a": spark.range(9), "b": bad}, root)
    assert publish.read_published(spark, root, "a").count() == 3  # not the 9 of the failed run
    assert publish.latest(spark, root) == one and one.note == {"run": "1"}
    publish.publish({"a": spark.range(7)}, root)
    assert publish.read_published(spark, root, "a").count() == 7
    assert publish.read_published(spark, root, "b", number=1).count() == 4
    with pytest.raises(KeyError):
        publish.read_published(spark, root, "b")
    assert publish.expire(spark, root, keep=1) == [1]
    assert [v.number for v in publish.versions(spark, root)] == [2]
    assert publish.read_published(spark, root, "a").count() == 7


def test_two_drafts_do_not_overwrite_each_other(spark):
    root = shared_path(spark, "published")
    a, b = publish.Draft(spark, root), publish.Draft(spark, root)
    a.write(spark.range(1), "t")
    b.write(spark.range(2), "t")
    a.commit()
    with pytest.raises(publish.PublishConflict):
        b.commit()
    assert publish.read_published(spark, root, "t").count() == 1


def test_a_failed_rerun_of_a_day_keeps_its_tables(spark, monkeypatch):
    from clientcurve import operators as O
    from clientcurve.plans.registry import run_for

    out = shared_path(spark, "runs")
    run_for(spark, SF_SMALL).write_outputs(out)
    day = f"{out}/run_date={run_for(spark, SF_SMALL).cfg.as_of}"
    before = rows_of(publish.read_published(spark, day, "changed_orgs"))

    def broken(_):
        raise RuntimeError("the second write fails")

    monkeypatch.setattr(O, "curve_movers", broken)
    with pytest.raises(RuntimeError):
        run_for(spark, SF_SMALL).write_outputs(out)
    assert rows_of(publish.read_published(spark, day, "changed_orgs")) == before
    assert publish.read_published(spark, day, "curve_movers").count() >= 0
    assert len(publish.versions(spark, day)) == 1


# ------------------------------------------------------------------ sweep line
INTERVALS = "econ_group string, adm_month string, dem_month string, headcount long"


def months(rnd, n):
    out = []
    for _ in range(n):
        a, b = sorted(rnd.sample(range(2000 * 12, 2022 * 12), 2))
        key = lambda i: f"{i // 12:04d}{i % 12 + 1:02d}"
        out.append((rnd.choice(["a", "b", "hot", "hot", "hot"]), key(a), "999912" if rnd.random() < 0.2 else key(b), rnd.randint(0, 9)))
    return out + [("a", None, "201001", 3), ("b", "201505", "201504", 4), ("c", "201001", "201001", 2), ("zero", "201001", "201005", 0), (None, "201001", "201005", 7)]


@pytest.mark.parametrize("start,end", [(dt.date(2001, 1, 15), dt.date(2002, 1, 14)), (dt.date(2000, 1, 1), dt.date(2020, 12, 31)), (dt.date(2010, 1, 1), dt.date(2010, 1, 1)), (dt.date(2010, 1, 2), dt.date(2010, 1, 20))])
def test_sweep_equals_the_expansion(spark, start, end):
    iv = spark.createDataFrame(months(random.Random(4), 300), INTERVALS)
    groups = spark.createDataFrame([("a",), ("hot",), ("c",), ("zero",), ("unseen",)], "econ_group string")
    assert rows_of(sweep.headcount_by_sweep(iv, groups, start, end)) == rows_of(active_headcount(iv, groups, start, end))


def test_daily_runs_equal_a_count_by_day(spark):
    rnd, first = random.Random(6), dt.date(2010, 1, 1)
    people = []
    for i in range(200):
        a = first + dt.timedelta(days=rnd.randint(-50, 400))
        people.append((f"c{rnd.randint(0, 5)}", f"e{i}", a, None if rnd.random() < 0.3 else a + dt.timedelta(days=rnd.randint(-2, 200))))
    codes = [(1, "c0", "g"), (2, "c1", "g"), (3, "c2", "h"), (4, "c3", None), (5, "c0", "h")]
    start, end = first, first + dt.timedelta(days=365)
    got = sweep.daily_headcount_runs(
        spark.createDataFrame(people, "client_code string, employee_code string, admitted date, dismissed date"),
        spark.createDataFrame(codes, "id long, code string, econ_group string"), start, end,
    ).collect()
    days = {}
    for r in got:
        assert r["from_date"] <= r["to_date"]
        for d in range((r["to_date"] - r["from_date"]).days + 1):
            assert days.setdefault((r["econ_group"], r["from_date"] + dt.timedelta(days=d)), r["active"]) == r["active"]
    want = {}
    for c, _, a, b in people:
        for _, code, g in codes:
            if code == c and g:
                for d in range(366):
                    day = start + dt.timedelta(days=d)
                    if a <= day <= (b or end):
                        want[g, day] = want.get((g, day), 0) + 1
    assert days == want
    ordered = sorted((r["econ_group"], r["from_date"], r["to_date"], r["active"]) for r in got)
    assert all(a[0] != b[0] or a[3] != b[3] or (b[1] - a[2]).days > 1 for a, b in zip(ordered, ordered[1:]))  # runs are as long as can be


# ------------------------------------------------------------------ ranges
def in_ranges(values, dim):
    out = []
    for i, v in values:
        held = [s for s, lo, hi in dim if v is not None and lo is not None and hi is not None and lo <= v <= hi]
        out += [(i, v, s) for s in held] or [(i, v, None)]
    return sorted(out, key=str)


def looked_up(spark, values, dim, small):
    df = spark.createDataFrame(values, "i long, v double")
    d = spark.createDataFrame(dim, "segment string, lo double, hi double")
    return rows_of(ranges.range_lookup(df, d, F.col("v"), {"segment": "segment"}, small=small))


@pytest.mark.parametrize("small", [0, 64])
def test_ranges_of_any_kind(spark, small):
    inf, rnd = math.inf, random.Random(2)
    dim = [("all", -inf, inf), ("up", 10.0, inf), ("down", -inf, -3.5), ("point", 2.0, 2.0), ("zero", -0.0, 0.0), ("tiny", 5e-324, 1e-300), ("none", 5.0, 4.0), ("null", None, 3.0), ("twice", 1.0, 4.0), ("twice", 1.0, 4.0), ("inf", inf, inf)]
    dim += [(f"r{i}", a, a + rnd.choice([0, 0.5, 3, 40])) for i, a in enumerate(rnd.uniform(-20, 20) for _ in range(30))]
    values = [(i, rnd.choice([rnd.uniform(-30, 30), rnd.choice([b for d in dim for b in d[1:] if b is not None])])) for i in range(300)]
    values += [(1000 + i, 2.0) for i in range(300)] + [(2000 + i, None) for i in range(300)]  # hot values
    values += [(3000, inf), (3001, -inf), (3002, 0.0), (3003, -0.0), (3004, math.nextafter(4.0, 5)), (3005, 1e308)]
    assert looked_up(spark, values, dim, small) == in_ranges(values, dim)


@pytest.mark.parametrize("small", [0, 64])
def test_empty_sides(spark, small):
    assert looked_up(spark, [(1, 2.0)], [], small) == [(1, 2.0, None)]
    assert looked_up(spark, [], [("a", 0.0, 1.0)], small) == []
    nan = spark.createDataFrame([(1, float("nan"))], "i long, v double")
    d = spark.createDataFrame([("a", -math.inf, math.inf), ("b", float("nan"), float("nan"))], "segment string, lo double, hi double")
    assert [r["segment"] for r in ranges.range_lookup(nan, d, F.col("v"), {"segment": "segment"}, small=small).collect()] == [None]


def test_a_million_ranges(spark):
    """Nested and disjoint ranges; the number of rows in between stays near that of the result."""
    n = 1_000_000
    dim = spark.range(n).select(F.col("id").cast("string").alias("segment"), F.col("id").cast("double").alias("lo"), (F.col("id") + F.lit(0.5)).alias("hi"))
    values = spark.range(20_000).select("id", (F.col("id") * 97.0 + F.when(F.col("id") % 2 == 0, 0.25).otherwise(0.75)).alias("v"))
    got = ranges.range_lookup(values, dim, F.col("v"), {"segment": "segment"})
    row = got.agg(F.count("*"), F.count("segment"), F.count_if(F.col("segment").cast("double") != F.col("id") * 97)).first()
    inside = sum(1 for i in range(0, 20_000, 2) if i * 97 < n)
    assert tuple(row) == (20_000, inside, 0)


def test_no_table_of_values_or_ranges_is_broadcast(spark):
    """Estimates took the values, once a level, for a small table, and sent them through the driver."""
    dim = spark.range(3000).selectExpr("CAST(id AS STRING) AS segment", "id * 10.0D AS lo", "id * 10.0D + 25 AS hi")
    values = spark.range(20_000).selectExpr("id", "id * 1.5D AS v")
    got = ranges.range_lookup(values, dim, F.col("v"), {"segment": "segment"})
    held = [sum(1 for k in range(int(i * 0.15) - 3, int(i * 0.15) + 1) if 0 <= k < 3000 and k * 10 <= i * 1.5 <= k * 10 + 25) for i in range(20_000)]
    assert tuple(got.agg(F.count("*"), F.count("segment")).first()) == (sum(max(1, n) for n in held), sum(held))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_large_blocks_are_shared(spark):
    """Wide ranges over many values, a hot one among them, and columns of the lookup's own names."""
    inf, n = math.inf, 70_000
    dim = [("all", -inf, inf), ("low", -inf, 40_000.5), ("up", 20_000.5, inf), ("mid", 10.0, 69_000.0), ("mid", 10.0, 69_000.0), ("point", 7.0, 7.0)]
    d = spark.createDataFrame(dim, "segment string, lo double, hi double")
    values = spark.range(n + 5000).selectExpr("id AS level", "id % 3 AS block", "CASE WHEN id < 70000 THEN CAST(id AS DOUBLE) WHEN id % 2 = 0 THEN 7.0D END AS x")
    got = ranges.range_lookup(values, d, F.col("x"), {"segment": "segment"}, small=0)
    assert got.columns == ["level", "block", "x", "segment"]
    assert {r["segment"]: (r["n"], r["ids"]) for r in got.groupBy("segment").agg(F.count("*").alias("n"), F.countDistinct("level").alias("ids")).collect()} == {
        "all": (n + 2500, n + 2500), "low": (40_001 + 2500, 40_001 + 2500), "up": (49_999, 49_999), "mid": (2 * 68_991, 68_991), "point": (2501, 2501), None: (2500, 2500),
    }


# ------------------------------------------------------------------ rounding
def test_rounding_equals_pythons(spark):
    rnd = random.Random(9)
    xs = [rnd.choice([rnd.uniform(-1000, 1000), rnd.randint(-(10**7), 10**7) / 1000, rnd.randint(-(10**6), 10**6) / 8, rnd.lognormvariate(0, 25) * rnd.choice([-1, 1])]) for _ in range(100_000)]
    xs += [2.675, 1.005, 0.125, 0.375, -2.675, 0.0, -0.0, 1e300, -1e22, 2.0**46, 2.0**46 - 0.005, 2.0**45 + 0.0078125, 5e-324, 0.005, 0.015, 1e15 + 0.5, 4503599627370495.5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double")
    for places in (0, 2, 6):
        got = {r["i"]: r["y"] for r in df.select("i", round_exact("x", places).alias("y")).collect()}
        wrong = [(x, got[i], round(x, places)) for i, x in enumerate(xs) if got[i] != round(x, places)]
        assert not wrong, wrong[:5]
    odd = spark.createDataFrame([(None,), (float("nan"),), (math.inf,), (-math.inf,)], "x double").select(round_exact("x", 2).alias("y")).collect()
    assert odd[0]["y"] is None and math.isnan(odd[1]["y"]) and [odd[2]["y"], odd[3]["y"]] == [math.inf, -math.inf]


# ------------------------------------------------------------------ sketches
def test_sketches_merge_over_any_runs(spark):
    path = shared_path(spark, "sketches")
    runs = {f"r{r}": spark.range(40_000).where(F.col("id") % 5 != r).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") % 900).cast("string")).alias("econ_group"), (27 + F.col("id") % 2).cast("int").alias("curve")) for r in range(4)}
    for name, rows in runs.items():
        distinct_sketch.append_sketches(distinct_sketch.class_sketches(rows, name), path)
    distinct_sketch.append_sketches(distinct_sketch.class_sketches(runs["r1"], "r1"), path)  # a repeated run
    stored = spark.read.parquet(path)
    assert {(r["curve"], r["orgs"], r["groups"]) for r in stored.where("run_id = 'r0'").collect()} == {(27, 16_000, 240), (28, 16_000, 240)}  # multiples of 5 are out
    for first, last, ids, groups in (("r0", "r0", 16_000, 240), ("r0", "r3", 20_000, 300), ("r1", "r2", 20_000, 300)):
        for r in distinct_sketch.merged_counts(stored, first, last).collect():
            assert abs(r["orgs"] - ids) <= 0.05 * ids and abs(r["groups"] - groups) <= 15
            assert r["runs"] == int(last[1]) - int(first[1]) + 1
