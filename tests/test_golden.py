"""Hand-made rows with hand-computed answers (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from clientcurve import operators as O
from clientcurve.functions import coerce_date, pandas_ne
from clientcurve.sources import dims
from clientcurve.sinks import writers

D = dt.date
AS_OF = D(2024, 6, 30)


def rows(df, *cols, order=None):
    df = df.select(*cols) if cols else df
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if order is None else out


def money(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


# ------------------------------------------------------------------ codes
def test_split_keeps_empty_pieces_and_outer_keeps_null(orgs_df):
    orgs = orgs_df([{"id": 1, "codes": "1.2..3"}, {"id": 2, "codes": None}, {"id": 3, "codes": "7"}])
    outer = rows(O.explode_codes(orgs, keep_null=True), "id", "code")
    assert outer == [(1, ""), (1, "1"), (1, "2"), (1, "3"), (2, None), (3, "7")]
    inner = rows(O.explode_codes(orgs), "id", "code")
    assert inner == [(1, ""), (1, "1"), (1, "2"), (1, "3"), (3, "7")]


# -------------------------------------------------------------------- ABC
def _abc(mk, pairs):
    g = mk([(k, money(v)) for k, v in pairs], "econ_group string, gross decimal(38,2)")
    return {r["econ_group"]: (r["cum_share"], r["curve"]) for r in O.abc_classify(g, num_partitions=3).collect()}


def test_abc_boundaries_inclusive(mk):
    res = _abc(mk, [("g1", 80), ("g2", 15), ("g3", 5)])
    assert res == {"g1": (0.8, 27), "g2": (0.95, 28), "g3": (1.0, 29)}


def test_abc_single_dominant_group_is_not_a(mk):
    assert _abc(mk, [("g", 100)]) == {"g": (1.0, 29)}


def test_abc_ties_use_rows_frame_and_name_order(mk):
    assert _abc(mk, [("b", 50), ("a", 50)]) == {"a": (0.5, 27), "b": (1.0, 29)}


def test_abc_zero_total_gives_no_class(mk):
    assert _abc(mk, [("a", 0), ("b", 0)]) == {"a": (None, 694), "b": (None, 694)}


# ---------------------------------------------------------------- revenue
def test_null_gross_group_sums_to_zero(invoices_df, orgs_df):
    inv = invoices_df([("5", D(2024, 6, 1), None, "F", 1)])
    orgs = orgs_df([{"id": 1, "codes": "5", "econ_group": "G"}])
    rev = O.client_month_revenue(inv, AS_OF)
    assert rows(O.group_revenue(rev, O.explode_codes(orgs))) == [("G", money(0))]


def test_shared_code_counts_revenue_twice(invoices_df, orgs_df):
    inv = invoices_df([("5", D(2024, 6, 1), money(10), "F", 1)])
    orgs = orgs_df([{"id": 1, "codes": "5", "econ_group": "G"}, {"id": 2, "codes": "5.6", "econ_group": "G"}])
    rev = O.client_month_revenue(inv, AS_OF)
    assert rows(O.group_revenue(rev, O.explode_codes(orgs))) == [("G", money(20))]


def test_cancelled_null_status_and_nfe_zero(invoices_df):
    inv = invoices_df(
        [
            ("1", D(2024, 6, 1), money(10), "C", 1),
            ("1", D(2024, 6, 2), money(20), None, 1),
            ("1", D(2024, 6, 3), money(40), "F", 0),
            ("1", D(2024, 6, 4), money(80), "F", 7),
        ]
    )
    assert rows(O.client_month_revenue(inv, AS_OF), "gross") == [(money(80),)]
    # invoice number 0 still counts for the billing span; null status does not
    assert rows(O.billing_span(inv)) == [("1", D(2024, 6, 3), D(2024, 6, 4))]
    facts = O.client_facts(inv, AS_OF)
    assert rows(facts) == [("1", D(2024, 6, 3), D(2024, 6, 4), money(80), 1)]


def test_revenue_window_is_inclusive(invoices_df):
    start = AS_OF - dt.timedelta(days=365)
    inv = invoices_df(
        [
            ("1", start - dt.timedelta(days=1), money(1), "F", 1),
            ("1", start, money(2), "F", 1),
            ("1", AS_OF, money(4), "F", 1),
            ("1", AS_OF + dt.timedelta(days=1), money(8), "F", 1),
        ]
    )
    assert sum(r["gross"] for r in O.client_month_revenue(inv, AS_OF).collect()) == money(6)


# ----------------------------------------------------------------- status
def test_recency_status(mk):
    df = mk(
        [
            (1, AS_OF - dt.timedelta(days=365)),
            (2, AS_OF - dt.timedelta(days=366)),
            (3, None),
            (4, AS_OF + dt.timedelta(days=1)),
        ],
        "id long, last_billed date",
    )
    out = rows(O.activity_status(df, AS_OF), "id", "days_since_last", "status")
    assert out == [(1, 365, 171), (2, 366, 172), (3, None, None), (4, -1, 171)]


def test_group_status_rollup(mk):
    df = mk(
        [
            (1, "A", 654, 10),
            (2, "A", 700, 400),
            (3, "B", 700, 400),  # lapsed member of a never-active group -> inactive
            (4, "B", 700, 10),
            (5, "C", 700, None),
            (6, None, 654, 10),
        ],
        "id long, econ_group string, group_status int, days_since_last int",
    )
    out = dict(rows(O.group_status_rollup(df), "id", "group_status"))
    assert out == {1: 654, 2: 654, 3: 655, 4: 655, 5: 700, 6: None}


# ------------------------------------------------------------------ flags
def test_null_tolerant_not_equal(mk):
    df = mk([(1, None, None), (2, None, 5), (3, 5, None), (4, 5, 5)], "id int, a int, b int")
    out = dict(rows(df.select("id", pandas_ne("a", "b").alias("ne"))))
    assert out == {1: True, 2: True, 3: True, 4: False}


def test_curve_flag(mk):
    df = mk([(1, None, 694), (2, None, 27), (3, 27, 27)], "id int, crm_curve int, curve int")
    assert dict(rows(O.flag_curve_change(df), "id", "curve_changed")) == {1: 0, 2: 1, 3: 0}


def test_group_status_flag(mk):
    df = mk([(1, None, 700), (2, None, None), (3, 654, 654)], "id int, crm_group_status int, group_status int")
    assert dict(rows(O.flag_group_status_change(df), "id", "group_status_changed")) == {1: 0, 2: 1, 3: 0}


def test_billing_flag_looks_at_last_date_only(mk):
    df = mk(
        [
            (1, D(2024, 1, 1), D(2024, 1, 2), D(2024, 5, 1), D(2024, 5, 1)),
            (2, D(2024, 1, 1), D(2024, 1, 1), D(2024, 5, 1), None),
            (3, None, None, None, None),
        ],
        "id int, first_billed date, crm_first date, last_billed date, crm_last date",
    )
    out = {r["id"]: (r["first_changed"], r["last_changed"], r["billing_changed"]) for r in O.flag_billing_change(df).collect()}
    assert out == {1: (True, False, 0), 2: (False, True, 1), 3: (True, True, None)}
    both = {r["id"]: r["billing_changed"] for r in O.flag_billing_change(df, include_first=True).collect()}
    assert both == {1: 1, 2: 1, 3: None}


def test_changed_filter_ignores_null_flags(mk):
    df = mk(
        [(1, None, None, 0, 0), (2, 1, None, None, 0), (3, None, None, None, 1), (4, 0, 0, 0, 0)],
        "id int, billing_changed int, status_changed int, curve_changed int, group_status_changed int",
    )
    assert sorted(r["id"] for r in O.changed_orgs(df).collect()) == [2, 3]


# ----------------------------------------------------------------- outbox
def test_outbox_only_status_changed(mk):
    df = mk(
        [(9, 1, 0, 0, False, False, 0, 172, 27, D(2024, 1, 1), D(2024, 5, 1), 654)],
        "id long, status_changed int, curve_changed int, billing_changed int, first_changed boolean, "
        "last_changed boolean, group_status_changed int, status int, curve int, first_billed date, "
        "last_billed date, group_status int",
    )
    ob = O.update_outbox(df)
    assert rows(ob) == [(9, "1.0.0.0.0", 172, None, None, None, None)]
    payload = O.update_payload(ob).collect()[0]["payload"]
    assert payload == '{"64506c623805f8b073a60555309a4bf2d0949f76":172}'


def test_outbox_dates_need_billing_flag(mk):
    df = mk(
        [(1, 0, 0, 1, True, True, 0, 171, 27, D(2024, 1, 1), D(2024, 5, 1), 654)],
        "id long, status_changed int, curve_changed int, billing_changed int, first_changed boolean, "
        "last_changed boolean, group_status_changed int, status int, curve int, first_billed date, "
        "last_billed date, group_status int",
    )
    ob = O.update_outbox(df)
    assert rows(ob) == [(1, "0.0.1.1.0", None, None, D(2024, 1, 1), D(2024, 5, 1), None)]


def test_curve_movers_trend(mk):
    df = mk(
        [("g1", 28, 27, 1), ("g2", 27, 29, 1), ("g3", 27, 694, 1), ("g4", None, 28, 1), ("g5", 27, 28, 0)],
        "econ_group string, crm_curve int, curve int, curve_changed int",
    )
    out = {r["econ_group"]: (r["old_label"], r["new_label"], r["trend"]) for r in O.curve_movers(df).collect()}
    assert out == {
        "g1": ("B", "A", "up"),
        "g2": ("A", "C", "down"),
        "g3": ("A", "694", "down"),
        "g4": (None, "B", "down"),
    }


def test_curve_summary_labels(mk):
    df = mk([(1, 27, "a"), (2, 27, "a"), (3, 27, "b"), (4, 694, None)], "id int, curve int, econ_group string")
    assert rows(O.curve_summary(df)) == [("694", 1, 0), ("A", 3, 2)]


def test_delivery_outcome_and_codes(spark, mk):
    log = mk([(1, 200, D(2024, 1, 1)), (2, 404, D(2024, 1, 1)), (3, None, D(2024, 1, 1))], "org_id long, http_code int, run_date date")
    out = {r["org_id"]: (r["outcome"], r["description"]) for r in O.delivery_report(log, dims.http_codes(spark)).collect()}
    assert out == {1: ("Sucesso", "OK"), 2: ("Falha", "Not Found"), 3: ("Erro", None)}


def test_report_route(mk):
    df = mk([(D(2024, 1, 5),), (D(2024, 1, 8),), (None,)], "run_date date")  # a Friday and a Monday
    out = rows(O.report_route(df))
    assert out == [(D(2024, 1, 5), 4, "Sexta", "weekly,daily"), (D(2024, 1, 8), 0, "Segunda", "daily")]


# --------------------------------------------------------------- calendar
def test_calendar_skips_partial_first_month(mk):
    b = mk([(D(2024, 3, 15), D(2024, 6, 1))], "start date, end date")
    assert [r["month"] for r in O.month_calendar(b).orderBy("month").collect()] == [202404, 202405, 202406]
    b2 = mk([(D(2024, 3, 1), D(2024, 3, 31))], "start date, end date")
    assert [r["month"] for r in O.month_calendar(b2).collect()] == [202403]


def test_group_month_grid(mk):
    g = mk([("a",), ("b",)], "econ_group string")
    out = rows(O.group_month_grid(g, D(2024, 1, 1), D(2024, 3, 10)))
    assert out == [("a", 202401), ("a", 202402), ("a", 202403), ("b", 202401), ("b", 202402), ("b", 202403)]


# -------------------------------------------------------------- headcount
def _intervals(mk, data):
    return mk(data, "econ_group string, adm_month string, dem_month string, headcount long")


def test_headcount_inclusive_interval(mk):
    iv = _intervals(mk, [("g", "202401", "202403", 2), ("g", None, "999912", 5)])
    groups = mk([("g",)], "econ_group string")
    out = rows(O.active_headcount(iv, groups, D(2024, 1, 1), D(2024, 6, 30)))
    assert out == [("g", "202401", 2), ("g", "202402", 2), ("g", "202403", 2)]


def test_headcount_open_interval_and_inactive_group(mk):
    iv = _intervals(mk, [("g", "202405", "999912", 3), ("x", "202401", "999912", 1)])
    groups = mk([("g",)], "econ_group string")
    out = rows(O.active_headcount(iv, groups, D(2024, 1, 1), D(2024, 6, 30)))
    assert out == [("g", "202405", 3), ("g", "202406", 3)]


def test_headcount_intervals_from_employees(mk, orgs_df):
    emp = mk(
        [("5", "e1", D(2024, 1, 3), D(2024, 3, 9)), ("5", None, D(2024, 1, 3), D(2024, 3, 9)), ("5", "e2", D(2024, 2, 1), None), ("8", "e3", D(2024, 1, 1), None)],
        "client_code string, employee_code string, admitted date, dismissed date",
    )
    orgs = orgs_df([{"id": 1, "codes": "5", "econ_group": "G"}, {"id": 2, "codes": "8", "econ_group": None}])
    out = rows(O.headcount_intervals(emp, O.explode_codes(orgs)))
    assert out == [("G", "202401", "202403", 1), ("G", "202402", "999912", 1)]


def test_demand_skips_gap_months(mk):
    hc = mk([("g", "202401", 10), ("g", "202403", 15)], "econ_group string, month string, active long")
    out = rows(O.demand_mom(hc), "month", "prev_active", "demand", "pct")
    assert out == [("202403", 10, 0.5, 50.0)]


def test_demand_and_mean(mk):
    hc = mk(
        [("g", "202401", 10), ("g", "202402", 10), ("g", "202403", 15), ("h", "202401", 4), ("h", "202402", 4)],
        "econ_group string, month string, active long",
    )
    d = O.demand_mom(hc)
    assert rows(d, "econ_group", "month", "demand", "pct") == [("g", "202403", 0.5, 50.0)]
    groups = mk([("g",), ("h",)], "econ_group string")
    assert rows(O.mean_demand(d, groups)) == [("g", 0.5), ("h", None)]


def test_demand_zero_previous_is_dropped(mk):
    hc = mk([("g", "202401", 0), ("g", "202402", 3)], "econ_group string, month string, active long")
    assert O.demand_mom(hc).count() == 0


# --------------------------------------------------------------- segments
def test_segments_inclusive_with_gaps(spark, mk):
    days = mk([(0,), (30,), (31,), (366,), (-1,), (None,)], "days_since_last int")
    out = rows(O.segment(days, dims.dim_recency(spark), "days_since_last", "seg"))
    assert out == [(-1, None), (0, "R5"), (30, "R5"), (31, "R4"), (366, "R1"), (None, None)]
    dem = mk([(-10.0,), (0.0,), (0.005,), (0.04,), (0.0405,), (0.2,)], "mean_demand double")
    out = dict(rows(O.segment(dem, dims.dim_demand(spark), "mean_demand", "seg", 6)))
    assert out == {-10.0: "D1", 0.0: "D1", 0.005: None, 0.04: "D2", 0.0405: None, 0.2: "D5"}


def test_segment_rounding_absorbs_float_noise(spark, mk):
    dem = mk([(0.04000000000000001,)], "mean_demand double")
    assert rows(O.segment(dem, dims.dim_demand(spark), "mean_demand", "seg", 6), "seg") == [("D2",)]


# ------------------------------------------------------------ conversions
def test_date_coerce(mk):
    df = mk([("20240105",), ("x",), (None,)], "raw string")
    assert rows(df.select("raw", coerce_date("raw").alias("d"))) == [("20240105", D(2024, 1, 5)), ("x", None), (None, None)]


def test_history_union_schema_drift(spark, mk):
    a = writers.stamp_run(mk([(1, "x")], "id long, econ_group string"), dt.datetime(2024, 1, 1))
    b = writers.stamp_run(mk([(2, "y", "1.0.0.0.0")], "id long, econ_group string, change_code string"), dt.datetime(2024, 1, 8))
    u = writers.history_union(a, b)
    out = rows(u, "org_id", "change_code", "run_id")
    assert out == [(1, None, "20240101T000000"), (2, "1.0.0.0.0", "20240108T000000")]


def test_payload_json_is_flat_object(mk):
    ob = mk(
        [(1, 171, 28, D(2024, 1, 2), None, None)],
        "id long, status int, curve int, first_billed date, last_billed date, group_status int",
    )
    p = O.update_payload(ob).collect()[0]["payload"]
    assert p == (
        '{"64506c623805f8b073a60555309a4bf2d0949f76":171,"44cc10af09a12836d1843f5f5657484de7bc71d6":28,'
        '"3c324f964624bdc71b66ff21c0cfdf097dc39836":"2024-01-02"}'
    )


def test_shared_code_dedupe_option_counts_once(invoices_df, orgs_df):
    inv = invoices_df([("5", D(2024, 6, 1), money(10), "F", 1)])
    orgs = orgs_df(
        [
            {"id": 1, "codes": "5", "econ_group": "G"},
            {"id": 2, "codes": "5.6", "econ_group": "G"},
            {"id": 3, "codes": "5", "econ_group": "H"},
        ]
    )
    rev = O.client_month_revenue(inv, AS_OF)
    cm = O.explode_codes(orgs)
    assert rows(O.group_revenue(rev, cm)) == [("G", money(20)), ("H", money(10))]
    assert rows(O.group_revenue(rev, cm, dedupe=True)) == [("G", money(10)), ("H", money(10))]
    facts = O.client_facts(inv, AS_OF)
    assert rows(O.group_facts(facts, cm, dedupe=True), "econ_group", "window_gross") == [("G", money(10)), ("H", money(10))]
