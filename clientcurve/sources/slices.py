"""Balanced slices of a database table, from a histogram of its keys.

Equal steps between two dates make unequal slices: all rows before the first date,
and all null ones, fall into the first. Here the database counts its rows by month,
and the slices are cut where the running count says; a month too large for one slice
is divided by the remainder of a second, whole-number column. The slices are plain
SQL conditions. They are disjoint and together cover every row, null dates and dates
outside the histogram included, so rows that arrive after the count are read too."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def month_histogram_sql(table: str, column: str) -> str:
    """(k, n): rows by month as yyyymm; null where the column is."""
    month = f"YEAR({column}) * 100 + MONTH({column})"
    return f"SELECT {month} AS k, COUNT(*) AS n FROM {table} GROUP BY {month}"


def _first_day(month: int) -> str:
    return f"'{month // 100:04d}-{month % 100:02d}-01'"


def _next(month: int) -> int:
    return month + 1 if month % 100 < 12 else month + 89


def month_slices(column: str, histogram: Iterable[Sequence], slices: int, spread: str | None = None) -> list[str]:
    """Conditions of about ``slices`` slices of equal counts, from (yyyymm or None,
    count) rows. ``spread`` names the whole-number column that divides a month that
    is larger than a slice."""
    counts = {k: n for k, n in histogram if k is not None}
    nulls = sum(n for k, n in histogram if k is None) if not isinstance(histogram, dict) else 0
    target = max(1.0, (sum(counts.values()) + nulls) / max(1, slices))
    groups: list[tuple[list[int], int]] = []  # months, rows
    for month in sorted(counts):
        n = counts[month]
        if groups and groups[-1][1] + n / 2 <= target and groups[-1][1] < target and n <= target:
            groups[-1] = (groups[-1][0] + [month], groups[-1][1] + n)
        else:
            groups.append(([month], n))
    out = []
    for i, (months, n) in enumerate(groups):
        bounds = []
        if i:
            bounds.append(f"{column} >= {_first_day(months[0])}")
        if i + 1 < len(groups):
            bounds.append(f"{column} < {_first_day(groups[i + 1][0][0])}")
        if not bounds:
            bounds.append(f"{column} IS NOT NULL")
        out += _divided(" AND ".join(bounds), n, target, spread)
    if not groups:
        out.append(f"{column} IS NOT NULL")
    return out + _divided(f"{column} IS NULL", nulls, target, spread)


def _divided(condition: str, rows: int, target: float, spread: str | None) -> list[str]:
    parts = round(rows / target)
    if spread is None or parts < 2:
        return [condition]
    rest = f"ABS({spread}) % {parts}"
    return [f"({condition}) AND ({rest} = {r}" + (f" OR {spread} IS NULL)" if r == 0 else ")") for r in range(parts)]


def jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, slices: int, properties: dict | None = None, spread: str | None = None, fetch_size: int = 10000) -> DataFrame:
    """A database table read in balanced slices of ``column``, a date. The histogram
    has a row a month."""
    from .readers import jdbc_query

    histogram = [(r[0], r[1]) for r in jdbc_query(spark, url, month_histogram_sql(table, column), properties).collect()]
    options = {"fetchsize": str(fetch_size)} | (properties or {})
    return spark.read.jdbc(url, table, predicates=month_slices(column, histogram, slices, spread), properties=options)
