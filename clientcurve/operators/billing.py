"""First and last billing dates: per client over all time, then per
organisation over its contract codes, and per economic group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .codes import explode_codes


def billing_span(invoices: DataFrame) -> DataFrame:
    """(client_code, first_billed, last_billed) over all non-cancelled invoices
    (invoice number 0 included)."""
    return (
        invoices.where(F.col("status") != C.CANCELLED_STATUS)
        .groupBy("client_code")
        .agg(F.min("issue_date").alias("first_billed"), F.max("issue_date").alias("last_billed"))
    )


def _code_dates(code_map: DataFrame, span: DataFrame) -> DataFrame:
    return code_map.join(span, code_map["code"] == span["client_code"], "inner")


def org_dates(code_map: DataFrame, span: DataFrame) -> DataFrame:
    """(id, first_billed, last_billed) for the organisations with at least one
    billed code: earliest first and latest last date over its codes."""
    return (
        _code_dates(code_map, span)
        .groupBy("id")
        .agg(F.min("first_billed").alias("first_billed"), F.max("last_billed").alias("last_billed"))
    )


def org_billing_span(orgs: DataFrame, span: DataFrame, code_map: DataFrame | None = None) -> DataFrame:
    """(id, first_billed, last_billed) for every organisation; null dates when
    none of its codes billed."""
    cm = code_map if code_map is not None else explode_codes(orgs)
    return orgs.select("id").join(org_dates(cm, span), "id", "left")
