"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from .dates import (
    coerce_date,
    days_between,
    month_key,
    month_starts_between,
)
from .labels import change_code, curve_label, delivery_outcome, trend, weekday_label, weekday_number
from .nulls import false_if_null, flag_is_one, pandas_ne, pandas_ne_flag, sum_or_zero

__all__ = [
    "change_code",
    "coerce_date",
    "curve_label",
    "days_between",
    "delivery_outcome",
    "false_if_null",
    "flag_is_one",
    "month_key",
    "month_starts_between",
    "pandas_ne",
    "pandas_ne_flag",
    "sum_or_zero",
    "trend",
    "weekday_label",
    "weekday_number",
]
