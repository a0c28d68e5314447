"""Rounding of the exact binary value of a double.

Spark's ``round`` takes a double by its shortest decimal text and rounds half up:
2.675 gives 2.68. The double nearest to 2.675 lies below it, so the correctly rounded
result is 2.67, and that is what the source of these figures reports."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1 cuts a double into two halves of 26 bits


def _halves(x: float) -> tuple[float, float]:
    t = x * _SPLIT
    high = t - (t - x)
    return high, x - high


def round_exact(x, places: int) -> Column:
    """``x`` (a double) rounded to ``places`` decimal places, 0 to 22: the decimal
    nearest to the exact value of the double, exact ties to the even digit, then the
    double nearest to that decimal. Null, NaN and infinities stay.

    With s = 10**places, x * s is held as p + e without error (error-free product).
    n = floor(p) is a whole number below 2**53, so p - n is exact, and the sign of
    (p - n - 1/2) + e tells on which side of the middle x * s lies. n / s is the
    double nearest to the decimal. Where s * x would reach 2**53 the doubles lie
    further apart than the decimals, and x is its own result."""
    if not 0 <= places <= 22:
        raise ValueError("powers of ten are exact doubles up to 10**22")
    x = F.col(x) if isinstance(x, str) else x
    s = 10.0**places
    limit = 2.0 ** (math.floor(52 - math.log2(s)) + 1)
    s_high, s_low = _halves(s)
    a = F.abs(x)
    p = a * F.lit(s)
    t = a * F.lit(_SPLIT)
    high = t - (t - a)
    low = a - high
    e = ((high * F.lit(s_high) - p) + high * F.lit(s_low) + low * F.lit(s_high)) + low * F.lit(s_low)
    n = F.floor(p).cast("double")
    over = (p - n) - F.lit(0.5)
    side = over + e
    up = (side > 0) | ((side == 0) & (n % 2 == 1))
    rounded = (n + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(s)
    signed = F.when(x < 0, -rounded).otherwise(rounded)
    return F.when(a < F.lit(limit), signed).otherwise(x)
