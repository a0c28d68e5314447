"""Run parameters and the fixed codes of the client-billing model.

Everything a run depends on is passed explicitly: the run date (``as_of``)
replaces every "today" of the original batch job, so a run is reproducible
and can be re-executed after a failure with identical results.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These are the option ids, thresholds, labels and field keys of
# the CRM the results are written back to; they must keep exactly these values
# for the outputs to mean the same thing.
# ---------------------------------------------------------------------------

# ABC curve option ids (A, B, C) and the "no class" id.
CURVE_A = 27
CURVE_B = 28
CURVE_C = 29
CURVE_NONE = 694
# Cumulative revenue share limits (inclusive) of classes A and B.
CURVE_A_MAX_SHARE = 0.80
CURVE_B_MAX_SHARE = 0.95
# Labels of the curve ids in reports; other ids are shown as their number.
CURVE_LABELS = {27: "A", 28: "B", 29: "C"}

# Economic-group status ids: active, inactive, never active.
GROUP_ACTIVE = 654
GROUP_INACTIVE = 655
GROUP_NEVER = 700

# Organisation status ids: active (billed within ACTIVE_DAYS), inactive.
ORG_ACTIVE = 171
ORG_INACTIVE = 172
ACTIVE_DAYS = 365

# Revenue analysis window, in days back from the run date (inclusive).
WINDOW_DAYS = 365

# Invoice status of a cancelled invoice.
CANCELLED_STATUS = "C"

# Month key used for "not dismissed".
OPEN_MONTH = "999912"

# CRM field keys of the update payload.
FIELD_KEYS = {
    "status": "64506c623805f8b073a60555309a4bf2d0949f76",
    "curve": "44cc10af09a12836d1843f5f5657484de7bc71d6",
    "first_billed": "3c324f964624bdc71b66ff21c0cfdf097dc39836",
    "last_billed": "fbe5a67d1d2bc41850c675402c2456ac50780dad",
    "group_status": "8cc8862b52157830bf56ee015fcedcca7ea75dba",
}

# Delivery outcome labels: HTTP 200, any other code, no response.
OUTCOME_SUCCESS = "Sucesso"
OUTCOME_FAILURE = "Falha"
OUTCOME_ERROR = "Erro"
SUCCESS_HTTP_CODE = 200

# Weekday labels, Monday first; the weekly report goes out on WEEKLY_WEEKDAY.
WEEKDAY_LABELS = ["Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"]
WEEKLY_WEEKDAY = 4

# Recency segments: (id, segment, min days, max days), both bounds inclusive.
RECENCY_SEGMENTS = [
    (1, "R1", 366, 99999999),
    (2, "R2", 211, 365),
    (3, "R3", 91, 210),
    (4, "R4", 31, 90),
    (5, "R5", 0, 30),
]
# Demand segments: (id, segment, min, max) of the mean month-over-month demand.
DEMAND_SEGMENTS = [
    (1, "D1", -10.0, 0.0),
    (2, "D2", 0.01, 0.04),
    (3, "D3", 0.041, 0.08),
    (4, "D4", 0.081, 0.12),
    (5, "D5", 0.121, 10.0),
]

# Link pattern of the HTTP status reference pages in the delivery report.
HTTP_DOC_LINK = "https://developer.mozilla.org/en-US/docs/Web/HTTP/Reference/Status/{code}"

# ---------------------------------------------------------------------------
# Defaults of the driver fixture binding (see FIXTURES.md).
# ---------------------------------------------------------------------------
DEFAULT_AS_OF = _dt.date(2001, 8, 1)


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one run. ``as_of`` is the run date."""

    as_of: _dt.date = DEFAULT_AS_OF
    window_days: int = WINDOW_DAYS
    # Whole months: from the first day of the month that starts the window to
    # the last day of the month before the run.
    month_aligned: bool = False
    # Leave out invoices dated after the run date from billing dates, so that a
    # past date gives the same dates however often it is run again.
    billing_until_as_of: bool = False
    active_days: int = ACTIVE_DAYS
    a_max_share: float = CURVE_A_MAX_SHARE
    b_max_share: float = CURVE_B_MAX_SHARE
    # Count a changed first-billing date in the billing flag too (the original
    # job only looked at the last date).
    billing_include_first: bool = False
    # Count a contract code shared by several organisations of one group once
    # for that group (the original job counted it once per organisation).
    dedupe_shared_codes: bool = False
    field_keys: dict = field(default_factory=lambda: dict(FIELD_KEYS))

    @property
    def window_start(self) -> _dt.date:
        start = self.as_of - _dt.timedelta(days=self.window_days)
        return start.replace(day=1) if self.month_aligned else start

    @property
    def window_end(self) -> _dt.date:
        return self.as_of.replace(day=1) - _dt.timedelta(days=1) if self.month_aligned else self.as_of

    @property
    def run_ts(self) -> _dt.datetime:
        return _dt.datetime.combine(self.as_of, _dt.time())

    def with_as_of(self, as_of: _dt.date) -> "RunConfig":
        return replace(self, as_of=as_of, field_keys=dict(self.field_keys))
