"""Domain operators: each is a DataFrame -> DataFrame function built from
Spark's own expressions, joins, aggregates and windows."""

from .abc import abc_classify, cumulative_revenue, curve_class, org_abc
from .billing import billing_span, org_billing_span, org_dates
from .calendar import group_month_grid, month_calendar
from .changes import (
    changed_orgs,
    flag_billing_change,
    flag_changes,
    flag_curve_change,
    flag_group_status_change,
    flag_status_change,
)
from .codes import explode_codes, split_codes
from .demand import demand_mom, mean_demand
from .headcount import active_headcount, headcount_intervals
from .outbox import delivery_report, outbox_change_code, payload_column, update_outbox, update_payload
from .prefix import running_sum
from .revenue import (
    billable,
    client_facts,
    client_group_join,
    client_month_revenue,
    group_code_pairs,
    group_facts,
    group_revenue,
    group_window_revenue,
    total_revenue,
)
from .segments import rdm_profile, segment
from .status import activity_status, group_status_rollup
from .summary import curve_movers, curve_summary, report_route, status_movers

__all__ = [
    "abc_classify",
    "active_headcount",
    "activity_status",
    "billable",
    "billing_span",
    "changed_orgs",
    "client_facts",
    "client_group_join",
    "client_month_revenue",
    "cumulative_revenue",
    "curve_class",
    "curve_movers",
    "curve_summary",
    "delivery_report",
    "demand_mom",
    "explode_codes",
    "flag_billing_change",
    "flag_changes",
    "flag_curve_change",
    "flag_group_status_change",
    "flag_status_change",
    "group_code_pairs",
    "group_facts",
    "group_month_grid",
    "group_revenue",
    "group_status_rollup",
    "group_window_revenue",
    "headcount_intervals",
    "mean_demand",
    "month_calendar",
    "org_abc",
    "outbox_change_code",
    "payload_column",
    "org_billing_span",
    "org_dates",
    "rdm_profile",
    "report_route",
    "running_sum",
    "segment",
    "status_movers",
    "split_codes",
    "total_revenue",
    "update_outbox",
    "update_payload",
]
