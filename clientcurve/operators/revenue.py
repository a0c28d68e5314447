"""Invoice revenue: per client and month inside the analysis window, resolved
to economic groups through the contract-code map."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import lit_date, month_key
from ..functions.nulls import sum_or_zero
from ..session import materialize


def billable(invoices: DataFrame) -> DataFrame:
    """Invoices that count as revenue: not cancelled (a null status does not
    count either) and carrying an invoice number other than 0."""
    return invoices.where((F.col("status") != C.CANCELLED_STATUS) & (F.col("nfe_no") != 0))


def client_month_revenue(invoices: DataFrame, as_of: _dt.date, window_days: int = C.WINDOW_DAYS) -> DataFrame:
    """(client_code, month 'yyyyMM', gross, last_billed, first_billed) over the
    inclusive window ``[as_of - window_days, as_of]``.

    The window bounds are literals, so the date filter reaches the scan."""
    start = as_of - _dt.timedelta(days=window_days)
    return (
        billable(invoices)
        .where(F.col("issue_date").between(lit_date(start), lit_date(as_of)))
        .groupBy("client_code", month_key("issue_date").alias("month"))
        .agg(
            F.sum("gross").alias("gross"),
            F.max("issue_date").alias("last_billed"),
            F.min("issue_date").alias("first_billed"),
        )
    )


def client_facts(invoices: DataFrame, as_of: _dt.date, window_days: int = C.WINDOW_DAYS) -> DataFrame:
    """One row per client from a single pass over all non-cancelled invoices:
    (client_code, first_billed, last_billed, window_gross, window_rows).

    ``first/last_billed`` span all time (invoice number 0 included);
    ``window_gross`` / ``window_rows`` cover the revenue rows only (number
    other than 0, date inside the window). This is the one reduction of the
    fact table every later step reads: revenue, billing dates and the
    group roll-up all start from it, so the invoice history is scanned once."""
    start = as_of - _dt.timedelta(days=window_days)
    in_window = (F.col("nfe_no") != 0) & F.col("issue_date").between(lit_date(start), lit_date(as_of))
    return (
        invoices.where(F.col("status") != C.CANCELLED_STATUS)
        .groupBy("client_code")
        .agg(
            F.min("issue_date").alias("first_billed"),
            F.max("issue_date").alias("last_billed"),
            F.sum(F.when(in_window, F.col("gross"))).alias("window_gross"),
            F.count(F.when(in_window, F.lit(1))).alias("window_rows"),
        )
    )


def group_code_pairs(code_map: DataFrame, dedupe: bool = False) -> DataFrame:
    """(code, econ_group) pairs of the code map with a group. By default one
    pair per owning organisation, so a code shared by several organisations
    of a group counts once per organisation (the source's behaviour); with
    ``dedupe`` each (code, group) pair counts once."""
    m = code_map.where(F.col("econ_group").isNotNull()).select("code", "econ_group")
    return m.distinct() if dedupe else m


def group_facts(facts: DataFrame, code_map: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per economic group from one join of the per-client facts with
    the code map: (econ_group, window_gross, window_rows, first_billed,
    last_billed). Window revenue, the active-group set and the group billing
    span are all read from this table."""
    m = group_code_pairs(code_map, dedupe)
    joined = facts.join(m, facts["client_code"] == m["code"], "inner")
    return joined.groupBy("econ_group").agg(
        F.sum("window_gross").alias("window_gross"),
        F.sum("window_rows").alias("window_rows"),
        F.min("first_billed").alias("first_billed"),
        F.max("last_billed").alias("last_billed"),
    )


def group_window_revenue(gfacts: DataFrame) -> DataFrame:
    """(econ_group, gross) for the groups with revenue rows in the window; a
    group whose window rows all have a null amount gets 0."""
    return gfacts.where(F.col("window_rows") > 0).select(
        "econ_group", F.coalesce(F.col("window_gross"), F.lit(0)).cast("decimal(38,2)").alias("gross")
    )


def client_group_join(client_rev: DataFrame, code_map: DataFrame) -> DataFrame:
    """Every client-month row with the group of each organisation owning the
    client's code (left-join semantics: unmatched rows keep a null group; a
    code owned by several organisations repeats the row).

    Written as inner join + anti join instead of one LEFT join: a code shared
    by a large share of the organisations is a hot key on the *right* side,
    which AQE cannot split in a left outer join but can in an inner join. The
    anti join only needs the distinct codes, so a hot code collapses to one
    row before its shuffle. The client-month rows are stored first: both joins
    read them, and the anti join must not sink below their aggregate, where it
    would scan the invoices again."""
    client_rev = materialize(client_rev)
    m = code_map.select("code", "econ_group")
    matched = client_rev.join(m, client_rev["client_code"] == m["code"], "inner").drop("code")
    codes = code_map.select("code").distinct()
    unmatched = client_rev.join(codes, client_rev["client_code"] == codes["code"], "left_anti").withColumn(
        "econ_group", F.lit(None).cast("string")
    )
    return matched.unionByName(unmatched)


def group_revenue(client_rev: DataFrame, code_map: DataFrame, dedupe: bool = False) -> DataFrame:
    """(econ_group, gross): window revenue per economic group; a group whose
    revenue rows are all null gets 0.

    Months are summed per client *before* the join (sum distributes over the
    join's fan-out), so the join sees one row per client; partial
    aggregation happens map-side on both sums. (A run reads the same figure
    from :func:`group_facts`.)"""
    per_client = client_rev.groupBy("client_code").agg(F.sum("gross").alias("gross"))
    m = group_code_pairs(code_map, dedupe)
    joined = per_client.join(m, per_client["client_code"] == m["code"], "inner")
    return joined.groupBy("econ_group").agg(sum_or_zero("gross").cast("decimal(38,2)").alias("gross"))


def total_revenue(group_rev: DataFrame) -> DataFrame:
    """One row: the whole-table revenue (the share denominator)."""
    return group_rev.agg(sum_or_zero("gross").cast("decimal(38,2)").alias("total_gross"))
