"""Contract-code map: each organisation lists its contract codes in one
dot-separated text column; the map has one row per (organisation, code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_codes(codes) -> Column:
    """Split on a literal dot. Empty pieces ('1..2') are kept, like the source."""
    codes = F.col(codes) if isinstance(codes, str) else codes
    # split() takes a regular expression: the dot must be escaped.
    return F.split(codes, r"\.", -1)


def explode_codes(orgs: DataFrame, keep_null: bool = False) -> DataFrame:
    """(id, code, econ_group) per listed code.

    Organisations without codes are dropped, or kept once with a null code
    when ``keep_null`` is set. Organisations without a group keep a null
    group. The split and explode are narrow: no shuffle."""
    gen = F.explode_outer if keep_null else F.explode
    out = orgs.select("id", gen(split_codes("codes")).alias("code"), "econ_group")
    return out if keep_null else out.where(F.col("code").isNotNull())
