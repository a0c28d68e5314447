"""DuckDB SQL oracles, one per query of ``registry.QUERIES``.

Written independently of the Spark code, in plain SQL: global window
functions for the running share, a window MIN for the group roll-up, a
range join against a generated calendar for the headcount, CASE chains for
the flags. Base views follow FIXTURES.md §2 and are prefixed as CTEs.
"""

from __future__ import annotations

import datetime as _dt

from .. import config as C
from .registry import PREVIOUS_RUN_GAP_DAYS

AS_OF = C.DEFAULT_AS_OF
PREV_AS_OF = AS_OF - _dt.timedelta(days=PREVIOUS_RUN_GAP_DAYS)


def _d(x: _dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _s(text) -> str:
    if text is None:
        return "NULL"
    return "'" + str(text).replace("'", "''") + "'"


BASE = [
    (
        "invoices",
        """
    SELECT CAST(o_custkey AS VARCHAR) AS client_code,
           CAST(o_orderdate AS DATE) AS issue_date,
           CAST(o_totalprice AS DECIMAL(18,2)) AS gross,
           CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'C' ELSE o_orderstatus END AS status,
           o_orderkey % 50 AS nfe_no
    FROM orders""",
    ),
    (
        "employees",
        """
    SELECT CAST(o_custkey AS VARCHAR) AS client_code,
           CAST(o_orderkey AS VARCHAR) AS employee_code,
           CAST(o_orderdate AS DATE) AS admitted,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL
                ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INTEGER) END AS dismissed
    FROM orders""",
    ),
    (
        "orgs",
        """
    SELECT c_custkey AS id,
      CASE WHEN c_custkey % 10 = 9 THEN NULL
           WHEN c_custkey % 10 = 0 THEN concat_ws('.', c_custkey, c_custkey + 9)
           ELSE CAST(c_custkey AS VARCHAR) END AS codes,
      CASE WHEN c_acctbal < 0 THEN NULL
           WHEN c_custkey % 20 = 9 THEN concat('SOLO_', c_custkey)
           ELSE concat('GRP_', CAST(floor(c_custkey / 4) AS BIGINT)) END AS econ_group,
      CASE c_custkey % 8 WHEN 0 THEN 28 WHEN 1 THEN 29 WHEN 2 THEN NULL ELSE 27 END AS crm_curve,
      CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE mn END AS crm_first,
      CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN mx - 30 ELSE mx END AS crm_last,
      CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 172 ELSE 171 END AS crm_status,
      CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN 655
           WHEN c_custkey % 20 = 9 THEN 700 ELSE 654 END AS crm_group_status
    FROM customer
    LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS mn, max(CAST(o_orderdate AS DATE)) AS mx
               FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderkey % 4 = 0) GROUP BY 1)
      ON o_custkey = c_custkey""",
    ),
    (
        "delivery_log",
        """
    SELECT event_id AS org_id,
           CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 201
                           WHEN 'purchase' THEN 404 WHEN 'error' THEN 500 ELSE NULL END AS http_code,
           CAST(ts AS DATE) AS run_date
    FROM events""",
    ),
    (
        "code_map",
        """
    SELECT id, code, econ_group
    FROM (SELECT id, unnest(string_split(codes, '.')) AS code, econ_group FROM orgs WHERE codes IS NOT NULL)
    WHERE code IS NOT NULL""",
    ),
    (
        "span",
        """
    SELECT client_code, min(issue_date) AS first_billed, max(issue_date) AS last_billed
    FROM invoices WHERE status <> 'C' GROUP BY client_code""",
    ),
    (
        "org_dates",
        """
    SELECT m.id, min(s.first_billed) AS first_billed, max(s.last_billed) AS last_billed
    FROM code_map m JOIN span s ON m.code = s.client_code GROUP BY m.id""",
    ),
]


def run_ctes(as_of: _dt.date, sfx: str = "") -> list[tuple[str, str]]:
    start = as_of - _dt.timedelta(days=C.WINDOW_DAYS)
    return [
        (
            f"client_rev{sfx}",
            f"""
    SELECT client_code, strftime(issue_date, '%Y%m') AS month, sum(gross) AS gross,
           max(issue_date) AS last_billed, min(issue_date) AS first_billed
    FROM invoices
    WHERE status <> 'C' AND nfe_no <> 0 AND issue_date >= {_d(start)} AND issue_date <= {_d(as_of)}
    GROUP BY 1, 2""",
        ),
        (
            f"group_rev{sfx}",
            f"""
    SELECT m.econ_group, coalesce(sum(r.gross), 0) AS gross
    FROM client_rev{sfx} r LEFT JOIN code_map m ON r.client_code = m.code
    WHERE m.econ_group IS NOT NULL
    GROUP BY m.econ_group""",
        ),
        (
            f"abc{sfx}",
            f"""
    SELECT econ_group, gross, cum_gross, cum_share,
           CASE WHEN cum_share <= 0.80::DOUBLE THEN 27
                WHEN cum_share > 0.80::DOUBLE AND cum_share <= 0.95::DOUBLE THEN 28
                WHEN cum_share > 0.95::DOUBLE THEN 29
                ELSE 694 END AS curve,
           654 AS group_status
    FROM (
      SELECT econ_group, gross, cum_gross,
             CAST(cum_gross AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) AS cum_share
      FROM (
        SELECT econ_group, gross,
               sum(gross) OVER (ORDER BY gross DESC, econ_group ASC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_gross,
               sum(gross) OVER () AS total
        FROM group_rev{sfx}))""",
        ),
        (
            f"org_status{sfx}",
            f"""
    SELECT o.*, coalesce(a.curve, 694) AS curve, coalesce(a.group_status, 700) AS gs0,
           d.first_billed, d.last_billed,
           date_diff('day', d.last_billed, {_d(as_of)}) AS days_since_last,
           CASE WHEN d.last_billed IS NULL THEN NULL
                WHEN date_diff('day', d.last_billed, {_d(as_of)}) <= 365 THEN 171 ELSE 172 END AS status
    FROM orgs o
    LEFT JOIN abc{sfx} a ON o.econ_group = a.econ_group
    LEFT JOIN org_dates d ON o.id = d.id""",
        ),
        (
            f"org_roll{sfx}",
            f"""
    SELECT *,
           CASE WHEN econ_group IS NULL THEN NULL
                ELSE min(CASE WHEN days_since_last > 365 AND gs0 = 700 THEN 655 ELSE gs0 END)
                       OVER (PARTITION BY econ_group) END AS group_status
    FROM org_status{sfx}""",
        ),
        (
            f"org_flags{sfx}",
            f"""
    SELECT *,
      coalesce(first_billed <> crm_first, TRUE) AS first_changed,
      coalesce(last_billed <> crm_last, TRUE) AS last_changed,
      CASE WHEN last_billed IS NULL THEN NULL
           WHEN coalesce(last_billed <> crm_last, TRUE) THEN 1 ELSE 0 END AS billing_changed,
      CASE WHEN days_since_last IS NULL THEN NULL
           WHEN coalesce(crm_status <> status, TRUE) THEN 1 ELSE 0 END AS status_changed,
      CASE WHEN curve IS NULL THEN NULL
           WHEN crm_curve IS NULL AND curve = 694 THEN 0
           WHEN coalesce(crm_curve <> curve, TRUE) THEN 1 ELSE 0 END AS curve_changed,
      CASE WHEN crm_group_status IS NULL AND group_status = 700 THEN 0
           WHEN coalesce(crm_group_status <> group_status, TRUE) THEN 1 ELSE 0 END AS group_status_changed
    FROM org_roll{sfx}""",
        ),
        (
            f"changed{sfx}",
            f"""
    SELECT * FROM org_flags{sfx}
    WHERE billing_changed = 1 OR status_changed = 1 OR curve_changed = 1 OR group_status_changed = 1""",
        ),
    ]


def _window_months(as_of: _dt.date) -> tuple[_dt.date, _dt.date]:
    start = as_of - _dt.timedelta(days=C.WINDOW_DAYS)
    first = start if start.day == 1 else (start.replace(day=1) + _dt.timedelta(days=32)).replace(day=1)
    return first, as_of.replace(day=1)


def demand_ctes(as_of: _dt.date) -> list[tuple[str, str]]:
    first, last = _window_months(as_of)
    return [
        (
            "cal",
            f"""
    SELECT strftime(m, '%Y%m') AS mkey
    FROM (SELECT unnest(generate_series(CAST({_d(first)} AS TIMESTAMP), CAST({_d(last)} AS TIMESTAMP),
                                        INTERVAL 1 MONTH)) AS m)""",
        ),
        (
            "emp_agg",
            """
    SELECT client_code, strftime(admitted, '%Y%m') AS adm_month, strftime(dismissed, '%Y%m') AS dem_month,
           count(employee_code) AS n
    FROM employees GROUP BY 1, 2, 3""",
        ),
        (
            "intervals",
            """
    SELECT m.econ_group, e.adm_month, coalesce(e.dem_month, '999912') AS dem_month, coalesce(sum(e.n), 0) AS headcount
    FROM emp_agg e LEFT JOIN code_map m ON e.client_code = m.code
    WHERE m.econ_group IS NOT NULL
    GROUP BY 1, 2, 3""",
        ),
        (
            "hc",
            """
    SELECT i.econ_group, c.mkey AS month, sum(i.headcount) AS active
    FROM (SELECT econ_group FROM group_rev) g
    JOIN intervals i ON i.econ_group = g.econ_group
    JOIN cal c ON i.adm_month <= c.mkey AND (i.dem_month >= c.mkey OR i.dem_month IS NULL)
    GROUP BY 1, 2""",
        ),
        (
            "dm",
            """
    SELECT econ_group, month, active, prev_active,
           coalesce(CAST(active - prev_active AS DOUBLE) / NULLIF(CAST(prev_active AS DOUBLE), 0), 0) AS demand
    FROM (SELECT econ_group, month, active,
                 lag(active) OVER (PARTITION BY econ_group ORDER BY month) AS prev_active FROM hc)""",
        ),
        ("demand", "SELECT *, CAST(printf('%.2f', demand * 100) AS DOUBLE) AS pct FROM dm WHERE demand <> 0"),
        (
            "mean_dem",
            """
    SELECT g.econ_group, avg(d.demand) AS mean_demand
    FROM (SELECT econ_group FROM group_rev) g LEFT JOIN demand d ON g.econ_group = d.econ_group
    GROUP BY g.econ_group""",
        ),
        (
            "group_span",
            """
    SELECT m.econ_group, min(s.first_billed) AS first_billed, max(s.last_billed) AS last_billed
    FROM code_map m JOIN span s ON m.code = s.client_code
    WHERE m.econ_group IS NOT NULL GROUP BY 1""",
        ),
        (
            "profile",
            f"""
    SELECT md.econ_group, md.mean_demand, r.gross, s.first_billed, s.last_billed,
           date_diff('day', s.last_billed, {_d(as_of)}) AS days_since_last
    FROM mean_dem md
    LEFT JOIN group_rev r ON md.econ_group = r.econ_group
    LEFT JOIN group_span s ON md.econ_group = s.econ_group""",
        ),
    ]


def _run_id(days: int) -> str:
    return (_dt.datetime.combine(AS_OF, _dt.time()) + _dt.timedelta(days=days)).strftime("%Y%m%dT%H%M%S")


def _with(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes) + "\n" + body.strip()


def _std(body: str, demand: bool = False) -> str:
    ctes = BASE + run_ctes(AS_OF)
    if demand:
        ctes = ctes + demand_ctes(AS_OF)
    return _with(ctes, body)


def _iso(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {alias or c.split('.')[-1]}"


def _money(c: str, alias: str | None = None) -> str:
    return f"CAST(round({c}, 2) AS DOUBLE) AS {alias or c.split('.')[-1]}"


def _ratio(c: str, alias: str | None = None) -> str:
    return f"round(CAST({c} AS DOUBLE), 6) AS {alias or c.split('.')[-1]}"


def _big(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS BIGINT) AS {alias or c.split('.')[-1]}"


FLAG_COLS = [
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

CHANGE_CODE = """CAST(coalesce(status_changed, 0) AS VARCHAR) || '.' ||
    CAST(coalesce(curve_changed, 0) AS VARCHAR) || '.' ||
    CASE WHEN first_changed AND billing_changed = 1 THEN '1' ELSE '0' END || '.' ||
    CASE WHEN last_changed AND billing_changed = 1 THEN '1' ELSE '0' END || '.' ||
    CAST(coalesce(group_status_changed, 0) AS VARCHAR)"""


def _outbox_body() -> str:
    return f"""
    SELECT id, {CHANGE_CODE} AS change_code,
      CASE WHEN status_changed = 1 THEN status END AS status,
      CASE WHEN curve_changed = 1 THEN curve END AS curve,
      CASE WHEN first_changed AND billing_changed = 1 THEN first_billed END AS first_billed,
      CASE WHEN last_changed AND billing_changed = 1 THEN last_billed END AS last_billed,
      CASE WHEN group_status_changed = 1 THEN group_status END AS group_status
    FROM changed"""


def _payload_sql() -> str:
    k = C.FIELD_KEYS
    return _std(
        f"""
    SELECT CAST(id AS BIGINT) AS id,
      '{{' || concat_ws(',',
        CASE WHEN status IS NOT NULL THEN '"{k['status']}":' || CAST(status AS VARCHAR) END,
        CASE WHEN curve IS NOT NULL THEN '"{k['curve']}":' || CAST(curve AS VARCHAR) END,
        CASE WHEN first_billed IS NOT NULL THEN '"{k['first_billed']}":"' || strftime(first_billed, '%Y-%m-%d') || '"' END,
        CASE WHEN last_billed IS NOT NULL THEN '"{k['last_billed']}":"' || strftime(last_billed, '%Y-%m-%d') || '"' END,
        CASE WHEN group_status IS NOT NULL THEN '"{k['group_status']}":' || CAST(group_status AS VARCHAR) END
      ) || '}}' AS payload
    FROM ({_outbox_body()})"""
    )


def _values(rows: list[tuple], cols: list[str], types: list[str]) -> str:
    body = ",\n      ".join(
        "(" + ", ".join(f"CAST({_s(v) if isinstance(v, str) or v is None else v} AS {t})" for v, t in zip(r, types)) + ")"
        for r in rows
    )
    return f"(VALUES\n      {body}) AS t({', '.join(cols)})"


def _history_sql() -> str:
    prev_ts = _dt.datetime.combine(PREV_AS_OF, _dt.time())
    cur_ts = _dt.datetime.combine(AS_OF, _dt.time())
    ctes = BASE + run_ctes(AS_OF) + run_ctes(PREV_AS_OF, "_prev")
    cols = ", ".join(FLAG_COLS)
    return _with(
        ctes,
        f"""
    SELECT CAST(id AS BIGINT) AS org_id, {cols},
           '{prev_ts:%Y-%m-%d %H:%M:%S}' AS updated_at, '{prev_ts:%Y%m%dT%H%M%S}' AS run_id,
           CAST(NULL AS VARCHAR) AS change_code
    FROM changed_prev
    UNION ALL
    SELECT CAST(id AS BIGINT) AS org_id, {cols},
           '{cur_ts:%Y-%m-%d %H:%M:%S}' AS updated_at, '{cur_ts:%Y%m%dT%H%M%S}' AS run_id,
           {CHANGE_CODE} AS change_code
    FROM changed""",
    )


def _two_runs_sql() -> str:
    both = " UNION ALL ".join(f"SELECT curve, id, econ_group, {i} AS run FROM changed{s}" for i, s in enumerate(("_prev", "")))
    return _with(
        BASE + run_ctes(AS_OF) + run_ctes(PREV_AS_OF, "_prev"),
        f"""SELECT CAST(curve AS BIGINT) AS curve, count(DISTINCT run) AS runs, count(DISTINCT id) AS orgs, count(DISTINCT econ_group) AS groups,
                   true AS orgs_near, true AS groups_near
            FROM ({both}) WHERE curve IS NOT NULL GROUP BY 1""",
    )


def oracle_sql() -> dict[str, str]:
    recency = _values([(1, "R1", 366, 99999999), (2, "R2", 211, 365), (3, "R3", 91, 210), (4, "R4", 31, 90), (5, "R5", 0, 30)], ["r_id", "segment", "lo", "hi"], ["INTEGER", "VARCHAR", "INTEGER", "INTEGER"])
    demand = _values([(1, "D1", -10.0, 0.0), (2, "D2", 0.01, 0.04), (3, "D3", 0.041, 0.08), (4, "D4", 0.081, 0.12), (5, "D5", 0.121, 10.0)], ["d_id", "segment", "lo", "hi"], ["INTEGER", "VARCHAR", "DOUBLE", "DOUBLE"])
    http = _values(
        # the codes that occur in the delivery log
        [(c, d, f"https://developer.mozilla.org/en-US/docs/Web/HTTP/Reference/Status/{c}") for c, d in ((200, "OK"), (201, "Created"), (404, "Not Found"), (500, "Internal Server Error"))],
        ["code", "description", "link"], ["INTEGER", "VARCHAR", "VARCHAR"]
    )
    weekday_labels = "[" + ", ".join(_s(x) for x in C.WEEKDAY_LABELS) + "]"
    q = {
        "client_month_revenue": _std(
            f"""SELECT client_code, month, {_money('gross')},
                   strftime(last_billed, '%Y%m%d') AS last_billed, strftime(first_billed, '%Y%m%d') AS first_billed
            FROM client_rev"""
        ),
        "client_billing_span": _std(
            """SELECT client_code, strftime(first_billed, '%Y%m%d') AS first_billed,
                      strftime(last_billed, '%Y%m%d') AS last_billed FROM span"""
        ),
        "headcount_intervals": _std(
            f"SELECT econ_group, adm_month, dem_month, {_big('headcount')} FROM intervals", demand=True
        ),
        "org_code_explode": _std(f"SELECT {_big('id')}, code, econ_group FROM code_map"),
        "org_code_explode_outer": _std(
            f"""SELECT {_big('id')}, code, econ_group FROM code_map
            UNION ALL
            SELECT {_big('id')}, CAST(NULL AS VARCHAR) AS code, econ_group FROM orgs WHERE codes IS NULL"""
        ),
        "client_group_join": _std(
            f"""SELECT r.client_code, r.month, {_money('r.gross')}, m.econ_group
            FROM client_rev r LEFT JOIN code_map m ON r.client_code = m.code"""
        ),
        "group_revenue": _std(f"SELECT econ_group, {_money('gross')} FROM group_rev"),
        "group_revenue_total": _std(
            f"SELECT {_money('coalesce(sum(gross), 0)', 'total_gross')} FROM group_rev"
        ),
        "group_cumulative_revenue": _std(
            f"SELECT econ_group, {_money('gross')}, {_money('cum_gross')} FROM abc"
        ),
        "abc_curve": _std(
            f"""SELECT econ_group, {_money('gross')}, {_money('cum_gross')}, {_ratio('cum_share')},
                   {_big('curve')}, {_big('group_status')} FROM abc"""
        ),
        "org_abc": _std(f"SELECT {_big('id')}, econ_group, {_big('curve')}, {_big('gs0', 'group_status')} FROM org_status"),
        "org_billing_span": _std(
            f"""SELECT {_big('id')}, {_big('curve')}, {_big('gs0', 'group_status')},
                   {_iso('first_billed')}, {_iso('last_billed')} FROM org_status"""
        ),
        "org_activity_status": _std(
            f"SELECT {_big('id')}, {_iso('last_billed')}, {_big('days_since_last')}, {_big('status')} FROM org_status"
        ),
        "group_status_rollup": _std(f"SELECT {_big('id')}, econ_group, {_big('group_status')} FROM org_roll"),
        "flag_billing_change": _std(
            f"""SELECT {_big('id')}, {_iso('first_billed')}, {_iso('crm_first')}, {_iso('last_billed')},
                   {_iso('crm_last')}, {_big('first_changed')}, {_big('last_changed')}, {_big('billing_changed')}
            FROM org_flags"""
        ),
        "flag_status_change": _std(
            f"""SELECT {_big('id')}, {_big('days_since_last')}, {_big('status')}, {_big('crm_status')},
                   {_big('status_changed')} FROM org_flags"""
        ),
        "flag_curve_change": _std(
            f"SELECT {_big('id')}, {_big('curve')}, {_big('crm_curve')}, {_big('curve_changed')} FROM org_flags"
        ),
        "flag_group_status_change": _std(
            f"""SELECT {_big('id')}, econ_group, {_big('group_status')}, {_big('crm_group_status')},
                   {_big('group_status_changed')} FROM org_flags"""
        ),
        "changed_orgs": _std(f"SELECT {_big('id')}, {', '.join(FLAG_COLS)} FROM changed"),
        "curve_summary": _std(
            """SELECT CASE curve WHEN 27 THEN 'A' WHEN 28 THEN 'B' WHEN 29 THEN 'C' ELSE CAST(curve AS VARCHAR) END AS curve,
                      CAST(count(curve) AS BIGINT) AS orgs, CAST(count(DISTINCT econ_group) AS BIGINT) AS groups
            FROM changed WHERE curve IS NOT NULL GROUP BY changed.curve"""
        ),
        "curve_movers": _std(
            """SELECT econ_group, CAST(old_curve AS BIGINT) AS old_curve, CAST(new_curve AS BIGINT) AS new_curve,
                      CASE old_curve WHEN 27 THEN 'A' WHEN 28 THEN 'B' WHEN 29 THEN 'C' ELSE CAST(old_curve AS VARCHAR) END AS old_label,
                      CASE new_curve WHEN 27 THEN 'A' WHEN 28 THEN 'B' WHEN 29 THEN 'C' ELSE CAST(new_curve AS VARCHAR) END AS new_label,
                      CASE WHEN new_curve < old_curve THEN 'up' ELSE 'down' END AS trend
            FROM (SELECT econ_group, min(crm_curve) AS old_curve, min(curve) AS new_curve
                  FROM changed WHERE curve_changed = 1 AND econ_group IS NOT NULL GROUP BY econ_group)"""
        ),
        "update_outbox": _std(
            f"""SELECT {_big('id')}, change_code, {_big('status')}, {_big('curve')}, {_iso('first_billed')},
                   {_iso('last_billed')}, {_big('group_status')} FROM ({_outbox_body()})"""
        ),
        "update_payload_json": _payload_sql(),
        "month_calendar": _std(
            """SELECT CAST(strftime(m, '%Y%m') AS BIGINT) AS month, strftime(m, '%Y-%m-%d') AS month_start
            FROM (SELECT unnest(generate_series(
                     CAST(CASE WHEN day(s) = 1 THEN s ELSE date_trunc('month', s) + INTERVAL 1 MONTH END AS TIMESTAMP),
                     CAST(date_trunc('month', e) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
                  FROM (SELECT e - 365 AS s, e FROM (SELECT max(issue_date) AS e FROM invoices)))"""
        ),
        "group_month_grid": _std(
            "SELECT g.econ_group, CAST(c.mkey AS BIGINT) AS month FROM group_rev g CROSS JOIN cal c", demand=True
        ),
        "active_headcount": _std(f"SELECT econ_group, month, {_big('active')} FROM hc", demand=True),
        "demand_mom": _std(
            f"""SELECT econ_group, month, {_big('active')}, {_big('prev_active')}, {_ratio('demand')},
                   CAST(pct AS DOUBLE) AS pct FROM demand""",
            demand=True,
        ),
        "mean_demand": _std(f"SELECT econ_group, {_ratio('mean_demand')} FROM mean_dem", demand=True),
        "rdm_profile": _std(
            f"""SELECT econ_group, {_ratio('mean_demand')}, {_money('gross')}, {_iso('first_billed')},
                   {_iso('last_billed')}, {_big('days_since_last')} FROM profile""",
            demand=True,
        ),
        "recency_segment": _std(
            f"""SELECT p.econ_group, {_big('p.days_since_last')}, t.segment AS recency_segment
            FROM profile p LEFT JOIN {recency} ON p.days_since_last BETWEEN t.lo AND t.hi""",
            demand=True,
        ),
        "demand_segment": _std(
            f"""SELECT p.econ_group, {_ratio('p.mean_demand')}, t.segment AS demand_segment
            FROM profile p LEFT JOIN {demand} ON round(p.mean_demand, 6) BETWEEN t.lo AND t.hi""",
            demand=True,
        ),
        "delivery_report": _std(
            f"""SELECT {_big('d.org_id')}, {_iso('d.run_date')}, {_big('d.http_code')},
                   CASE WHEN d.http_code IS NULL THEN 'Erro' WHEN d.http_code = 200 THEN 'Sucesso' ELSE 'Falha' END AS outcome,
                   t.description, t.link
            FROM delivery_log d LEFT JOIN {http} ON d.http_code = t.code"""
        ),
        "history_union": _history_sql(),
        "history_append_roundtrip": _history_sql(),
        "csv_pipe_roundtrip": _std(
            f"""SELECT {_big('id')}, codes, econ_group, {_big('crm_curve')}, {_iso('crm_first')}, {_iso('crm_last')},
                   {_big('crm_status')}, {_big('crm_group_status')} FROM orgs"""
        ),
        "status_movers": _std(
            f"""SELECT {_big('id')}, econ_group, CASE WHEN status = 172 THEN 'inactive' ELSE 'active' END AS movement
            FROM changed WHERE status_changed = 1"""
        ),
        "segment_file_roundtrip": _std(
            f"""SELECT p.econ_group, {_big('p.days_since_last')}, t.segment AS recency_segment
            FROM profile p LEFT JOIN {recency} ON p.days_since_last BETWEEN t.lo AND t.hi""",
            demand=True,
        ),
        "http_file_roundtrip": _std(
            f"""SELECT {_big('d.http_code')},
                   CASE WHEN d.http_code IS NULL THEN 'Erro' WHEN d.http_code = 200 THEN 'Sucesso' ELSE 'Falha' END AS outcome,
                   t.description, count(*) AS attempts
            FROM delivery_log d LEFT JOIN {http} ON d.http_code = t.code GROUP BY ALL"""
        ),
        "billing_state_two_runs": _std(
            f"""SELECT client_code, strftime(min(issue_date), '%Y%m%d') AS first_billed, strftime(max(issue_date), '%Y%m%d') AS last_billed,
                   CAST(round(sum(gross) FILTER (nfe_no <> 0 AND issue_date BETWEEN {_d(AS_OF)} - 365 AND {_d(AS_OF)}), 2) AS DOUBLE) AS window_gross,
                   count(*) FILTER (nfe_no <> 0 AND issue_date BETWEEN {_d(AS_OF)} - 365 AND {_d(AS_OF)}) AS window_rows
            FROM invoices WHERE status <> 'C' GROUP BY client_code"""
        ),
        "headcount_sweep": _std(f"SELECT econ_group, month, {_big('active')} FROM hc", demand=True),
        "headcount_daily_runs": _std(
            f""", days AS (
                SELECT m.econ_group, e.employee_code,
                       unnest(generate_series(CAST(greatest(e.admitted, {_d(AS_OF)} - 3650) AS TIMESTAMP),
                                              CAST(least(coalesce(e.dismissed, {_d(AS_OF)}), {_d(AS_OF)}) AS TIMESTAMP), INTERVAL 1 DAY)) AS day
                FROM employees e JOIN code_map m ON e.client_code = m.code WHERE m.econ_group IS NOT NULL),
              counts AS (SELECT econ_group, CAST(day AS DATE) AS day, count(employee_code) AS active FROM days GROUP BY ALL),
              isles AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY econ_group, active ORDER BY day) AS INTEGER) AS isle FROM counts)
            SELECT econ_group, {_iso('min(day)', 'from_date')}, {_iso('max(day)', 'to_date')}, {_big('active')}
            FROM isles GROUP BY econ_group, active, isle"""
        ),
        "exact_rounding": """
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(printf('%.2f', l_extendedprice / 8) AS DOUBLE) AS eighth,
                   CAST(printf('%.2f', l_extendedprice * (l_discount - 0.05::DOUBLE) / l_quantity) AS DOUBLE) AS about
            FROM lineitem""",
        "segment_intervals": """
            WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 50 = 2 THEN -'Infinity'::DOUBLE ELSE s_acctbal - 50 END AS lo,
                              CASE WHEN s_suppkey % 50 = 1 THEN 'Infinity'::DOUBLE ELSE s_acctbal + 50 END AS hi FROM supplier),
                 c AS (SELECT c_custkey, CASE WHEN c_custkey % 40 <> 0 THEN c_acctbal END AS balance FROM customer)
            SELECT c_custkey, balance, s_suppkey FROM c LEFT JOIN r ON balance BETWEEN lo AND hi""",
        "snapshot_rejects_roundtrip": _std(
            """SELECT reason, kept, count(*) AS rows FROM (
                SELECT CASE WHEN id % 50 IN (31, 37) THEN 'fields' WHEN id % 50 IN (9, 17) THEN 'id' ELSE 'orgs' END AS reason,
                       id % 50 NOT IN (9, 17, 31, 37) AS kept FROM orgs
                UNION ALL SELECT 'date', true FROM orgs WHERE id % 50 = 23)
            GROUP BY reason, kept"""
        ),
        "history_type_widening": f"""
            SELECT c_custkey AS org_id, CAST(c_nationkey AS BIGINT) AS nation, CAST(CAST(c_acctbal AS DECIMAL(8,2)) AS DOUBLE) AS balance,
                   c_name AS name, NULL AS segment, '{_run_id(0)}' AS run_id FROM customer
            UNION ALL
            SELECT c_custkey, c_nationkey * 10000000000, CAST(CAST(round(CAST(c_acctbal AS DECIMAL(20,4)) * 0.125, 4) AS DECIMAL(20,4)) AS DOUBLE), c_name, c_mktsegment, '{_run_id(7)}' FROM customer
            UNION ALL
            SELECT c_custkey, c_nationkey, CAST(trunc(c_acctbal) AS DOUBLE), NULL, c_mktsegment, '{_run_id(14)}' FROM customer""",
        "curve_distinct_merge": _two_runs_sql(),
        "delivery_report_roundtrip": _std(
            f"""SELECT {_iso('run_date')},
                   CASE WHEN http_code IS NULL THEN 'Erro' WHEN http_code = 200 THEN 'Sucesso' ELSE 'Falha' END AS outcome,
                   count(*) AS attempts
            FROM delivery_log GROUP BY ALL"""
        ),
        "date_coerce": _std(
            """SELECT source, key, raw, strftime(CAST(try_strptime(raw, '%Y%m%d') AS DATE), '%Y-%m-%d') AS parsed
            FROM (SELECT 'billing_first' AS source, client_code AS key, strftime(first_billed, '%Y%m%d') AS raw FROM span
                  UNION ALL
                  SELECT 'crm_first', CAST(id AS VARCHAR), strftime(crm_first, '%Y%m%d') FROM orgs
                  UNION ALL
                  SELECT 'segment', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer)"""
        ),
        "report_route": _std(
            f"""SELECT strftime(run_date, '%Y-%m-%d') AS run_date, CAST(isodow(run_date) - 1 AS BIGINT) AS weekday,
                   list_extract({weekday_labels}, isodow(run_date)) AS weekday_label,
                   CASE WHEN isodow(run_date) = 5 THEN 'weekly,daily' ELSE 'daily' END AS reports
            FROM (SELECT DISTINCT run_date FROM delivery_log WHERE run_date IS NOT NULL)"""
        ),
    }
    return q
