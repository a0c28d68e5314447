"""Date helpers. Dates stay DATE inside the library and are formatted only at
the output boundary. Parsing never throws: a bad value becomes null."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month keys are 'yyyyMM' strings: their text order is the calendar order.
MONTH_FMT = "yyyyMM"
DAY_FMT = "yyyyMMdd"
ISO_FMT = "yyyy-MM-dd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_key(d) -> Column:
    """DATE -> 'yyyyMM' (same text as date_format(d, 'yyyyMM'), built from
    integer parts, which is cheaper per row)."""
    d = _c(d)
    return F.lpad((F.year(d) * 100 + F.month(d)).cast("string"), 6, "0")


def coerce_date(text, fmt: str = DAY_FMT) -> Column:
    """Parse text as a date; an unparsable value gives null instead of an error."""
    return F.try_to_date(_c(text), fmt)


def first_month_start_on_or_after(d) -> Column:
    """The first month start that is not before ``d``."""
    d = _c(d)
    return F.when(F.dayofmonth(d) == 1, d).otherwise(F.add_months(F.trunc(d, "MM"), 1))


def month_starts_between(start, end) -> Column:
    """Array of the month starts that fall inside ``[start, end]``.

    A window that begins mid-month does not include that partial month."""
    first = first_month_start_on_or_after(_c(start))
    last = F.trunc(_c(end), "MM")
    return F.when(
        first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    ).otherwise(F.array().cast("array<date>"))


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` (negative if ``earlier`` is after)."""
    return F.datediff(_c(later), _c(earlier))


def lit_date(d: _dt.date) -> Column:
    return F.lit(d).cast("date")
