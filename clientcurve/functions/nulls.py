"""Null rules of the original pandas job, as Column expressions.

* ``a != b`` is true when either side, or both, is null (pandas compares NaN
  as unequal to everything, itself included). ``~eqNullSafe`` would call two
  nulls equal, so it is not used.
* An ordering comparison with null is false.
* A sum over a group of nulls is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pandas_ne(a, b) -> Column:
    """``a != b`` with null on either side counting as different."""
    return F.coalesce(_c(a) != _c(b), F.lit(True))


def pandas_ne_flag(a, b) -> Column:
    """:func:`pandas_ne` as a 1/0 integer flag."""
    return pandas_ne(a, b).cast("int")


def false_if_null(cond: Column) -> Column:
    """Comparison result with null read as false."""
    return F.coalesce(cond, F.lit(False))


def sum_or_zero(c) -> Column:
    """Sum whose all-null (or empty) groups give 0 instead of null."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def flag_is_one(c) -> Column:
    """``flag == 1`` with a null flag read as false."""
    return false_if_null(_c(c) == 1)
