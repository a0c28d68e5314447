"""Binding of the driver's TPC-H-like Parquet tables to the billing model.

The driver ships ``orders``, ``customer`` and ``events``; FIXTURES.md §2 maps
them onto the four logical inputs:

* ``invoices``  - one per order (cancelled = status 'P' on every 4th key, the
  invoice number is the key modulo 50, so number 0 occurs);
* ``employees`` - one per order (admitted on the order date, dismissed a
  key-dependent number of days later, or never);
* ``orgs``      - the CRM snapshot, one per customer, with codes, group and
  the stored values the run compares against;
* ``delivery_log`` - one per event, with an HTTP code per event type.

The key arithmetic only *derives attributes*; every row of every table flows
through. Only the columns used are read, so the scans prune columns.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C


# An order of status 'P' on every 4th key stands for a cancelled invoice.
_CANCELLED = "o_orderstatus = 'P' AND o_orderkey % 4 = 0"


@dataclass
class FixtureTables:
    """Lazily bound logical tables over one scale-factor folder."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @cached_property
    def invoices(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "CAST(o_custkey AS STRING) AS client_code",
            "CAST(o_orderdate AS DATE) AS issue_date",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS gross",
            f"CASE WHEN {_CANCELLED} THEN '{C.CANCELLED_STATUS}' ELSE o_orderstatus END AS status",
            "o_orderkey % 50 AS nfe_no",
        )

    def invoice_loads(self, cut: _dt.date) -> list[tuple[str, DataFrame]]:
        """The invoices as two loads of a log. The first holds those up to ``cut``,
        with cancelled ones still open and every 97th with another amount; the second
        the later ones, the cancellations and the right amounts."""
        rows = self.raw("orders").selectExpr(
            "o_orderkey AS invoice_id",
            "CAST(o_custkey AS STRING) AS client_code",
            "CAST(o_orderdate AS DATE) AS issue_date",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS gross",
            f"CASE WHEN {_CANCELLED} THEN '{C.CANCELLED_STATUS}' ELSE o_orderstatus END AS status",
            "o_orderkey % 50 AS nfe_no",
        )
        early = F.col("issue_date") <= F.lit(cut)
        changed = (F.col("status") == C.CANCELLED_STATUS) | (F.col("invoice_id") % 97 == 0)
        first = rows.where(early).select(
            "invoice_id", "client_code", "issue_date",
            F.when(F.col("invoice_id") % 97 == 0, F.col("gross") + 1).otherwise(F.col("gross")).cast("decimal(18,2)").alias("gross"),
            F.when(F.col("status") == C.CANCELLED_STATUS, F.lit("P")).otherwise(F.col("status")).alias("status"),
            "nfe_no", F.lit(False).alias("revised"),
        )
        second = rows.where(~early | changed).withColumn("revised", early)
        return [("0001", first), ("0002", second)]

    @cached_property
    def employees(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "CAST(o_custkey AS STRING) AS client_code",
            "CAST(o_orderkey AS STRING) AS employee_code",
            "CAST(o_orderdate AS DATE) AS admitted",
            "CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS DATE) "
            "ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 900 AS INT)) END AS dismissed",
        )

    @cached_property
    def orgs(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_acctbal")
        # Stored billing dates: the true span of the customer's non-cancelled orders.
        span = self.raw("orders").where(f"NOT ({_CANCELLED})").groupBy("o_custkey").agg(
            F.min(F.col("o_orderdate").cast("date")).alias("mn"),
            F.max(F.col("o_orderdate").cast("date")).alias("mx"),
        )
        return c.join(span, c["c_custkey"] == span["o_custkey"], "left").selectExpr(
            "c_custkey AS id",
            "CASE WHEN c_custkey % 10 = 9 THEN CAST(NULL AS STRING) "
            "WHEN c_custkey % 10 = 0 THEN concat_ws('.', CAST(c_custkey AS STRING), CAST(c_custkey + 9 AS STRING)) "
            "ELSE CAST(c_custkey AS STRING) END AS codes",
            "CASE WHEN c_acctbal < 0 THEN CAST(NULL AS STRING) "
            "WHEN c_custkey % 20 = 9 THEN concat('SOLO_', CAST(c_custkey AS STRING)) "
            "ELSE concat('GRP_', CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING)) END AS econ_group",
            "CASE c_custkey % 8 WHEN 0 THEN 28 WHEN 1 THEN 29 WHEN 2 THEN CAST(NULL AS INT) ELSE 27 END AS crm_curve",
            "CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS DATE) ELSE mn END AS crm_first",
            "CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS DATE) WHEN c_custkey % 4 = 1 THEN date_sub(mx, 30) "
            "ELSE mx END AS crm_last",
            "CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS INT) WHEN c_custkey % 5 = 1 THEN 172 ELSE 171 END AS crm_status",
            "CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS INT) WHEN c_custkey % 7 = 1 THEN 655 "
            "WHEN c_custkey % 20 = 9 THEN 700 ELSE 654 END AS crm_group_status",
        )

    @cached_property
    def delivery_log(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS org_id",
            "CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 201 WHEN 'purchase' THEN 404 "
            "WHEN 'error' THEN 500 ELSE CAST(NULL AS INT) END AS http_code",
            "CAST(ts AS DATE) AS run_date",
        )
