"""Billing spans and window revenue kept up to date from new invoices only.

A run needs, for each client, the first and last billing date of all time and the
revenue of the window. Both are sums of parts: minima, maxima, and revenue by day.
The state holds them, and a run merges into it what the new loads bring instead of
reading all history again.

Invoices come as a log, partitioned by load and by a bucket of the client:

    invoice_id, client_code, issue_date, gross, status, nfe_no, revised, load, bucket

A minimum cannot be taken back, so a client for which a load brings a *cancelled* or
a *revised* invoice (one that replaces an earlier version of itself) is touched:
everything of that client is reduced anew, from the newest version of each of its
invoices. Only the buckets of touched clients are read for that. An invoice keeps
its client; one that moves is cancelled with the old client and new with the other.

The state is two tables, published together (``sinks.publish``) with the list of the
loads they hold, so a failed run changes nothing and a repeated one does nothing:

    spans   client_code, first_billed, last_billed, bucket
    days    client_code, issue_date, gross, rows, bucket     (the last ``keep_days`` only)

All reductions are partial before they are shuffled, so a client with a third of all
invoices is one row a task.

Defined cases: rows without a status, or with a null date, count as in
``client_facts`` (no status: not billed; a null date: in no span); a null client is
a client; a load that repeats an invoice has one version of it, the largest in
(date, amount, status, number); an empty load changes nothing but the list.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import lit_date
from ..sinks import publish

BUCKETS = 64
KEEP_DAYS = 2 * C.WINDOW_DAYS  # a window ends at the run date or up to a year before


def bucket_of(client, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(client), F.lit(buckets)).cast("int")


def append_load(invoices: DataFrame, path: str, load: str, buckets: int = BUCKETS) -> None:
    """Write one load of the log; writing it again replaces it."""
    rows = invoices.select("invoice_id", "client_code", "issue_date", "gross", "status", "nfe_no", F.coalesce("revised", F.lit(False)).alias("revised"))
    rows = rows.withColumn("load", F.lit(load)).withColumn("bucket", bucket_of("client_code", buckets))
    rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load", "bucket").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; conditions on ``load`` and ``bucket`` prune its folders."""
    kinds = "invoice_id long, client_code string, issue_date date, gross decimal(18,2), status string, nfe_no long, revised boolean, load string, bucket int"
    return spark.read.schema(kinds).parquet(path)


def newest_versions(log: DataFrame) -> DataFrame:
    """One row an invoice and client: its version of the last load."""
    last = F.max(F.struct("load", "issue_date", "gross", "status", "nfe_no")).alias("v")
    return log.groupBy("invoice_id", "client_code").agg(last, F.first("bucket").alias("bucket")).select("client_code", "v.issue_date", "v.gross", "v.status", "v.nfe_no", "bucket")


def _billed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status") != C.CANCELLED_STATUS)


def spans_of(rows: DataFrame) -> DataFrame:
    """(client_code, first_billed, last_billed, bucket) of invoice versions."""
    return _billed(rows).groupBy("client_code", "bucket").agg(F.min("issue_date").alias("first_billed"), F.max("issue_date").alias("last_billed")).select("client_code", "first_billed", "last_billed", "bucket")


def days_of(rows: DataFrame, since: _dt.date) -> DataFrame:
    """(client_code, issue_date, gross, rows, bucket) of revenue from ``since`` on."""
    counted = _billed(rows).where((F.col("nfe_no") != 0) & (F.col("issue_date") >= lit_date(since)))
    sums = counted.groupBy("client_code", "issue_date", "bucket").agg(F.sum("gross").alias("gross"), F.count("*").alias("rows"))
    return sums.select("client_code", "issue_date", F.col("gross").cast("decimal(28,2)").alias("gross"), "rows", "bucket")


def merge_spans(*parts: DataFrame) -> DataFrame:
    return _union(parts).groupBy("client_code", "bucket").agg(F.min("first_billed").alias("first_billed"), F.max("last_billed").alias("last_billed")).select("client_code", "first_billed", "last_billed", "bucket")


def merge_days(since: _dt.date, *parts: DataFrame) -> DataFrame:
    rows = _union(parts).where(F.col("issue_date") >= lit_date(since))
    sums = rows.groupBy("client_code", "issue_date", "bucket").agg(F.sum("gross").alias("gross"), F.sum("rows").alias("rows"))
    return sums.select("client_code", "issue_date", F.col("gross").cast("decimal(28,2)").alias("gross"), "rows", "bucket")


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def touched_clients(fresh: DataFrame) -> DataFrame:
    """(client_code, bucket) with a cancelled or revised invoice in the new loads."""
    return fresh.where((F.col("status") == C.CANCELLED_STATUS) | F.col("revised")).select("client_code", "bucket").distinct()


def _without(rows: DataFrame, clients: DataFrame) -> DataFrame:
    c = clients.select(F.col("client_code").alias("_c"))
    return rows.join(c, rows["client_code"].eqNullSafe(c["_c"]), "left_anti")


def _only(rows: DataFrame, clients: DataFrame) -> DataFrame:
    c = clients.select(F.col("client_code").alias("_c"))
    return rows.join(c, rows["client_code"].eqNullSafe(c["_c"]), "left_semi")


def update_state(spark: SparkSession, log_path: str, state_root: str, loads: list[str], as_of: _dt.date, keep_days: int = KEEP_DAYS, keep: int = 2) -> publish.Version:
    """Merge the given loads into the state at ``state_root`` and publish it. Loads
    that it holds already are left out; with none new, the state stays as it is. The
    newest ``keep`` versions stay."""
    before = publish.latest(spark, state_root)
    held = before.note["loads"].split(",") if before and before.note.get("loads") else []
    new = sorted(set(loads) - set(held))
    if before and not new:
        return before
    since = as_of - _dt.timedelta(days=keep_days)
    log = read_log(spark, log_path)
    fresh = log.where(F.col("load").isin(new))
    draft = publish.Draft(spark, state_root)
    if not before:
        rows = newest_versions(fresh)
        draft.write(spans_of(rows), "spans")
        draft.write(days_of(rows, since), "days")
        return draft.commit({"loads": ",".join(new)})
    touched = draft.write(touched_clients(fresh), "touched")
    old = {t: _without(before.read(spark, t), touched) for t in ("spans", "days")}
    plain = _without(fresh, touched)
    spans, days = [old["spans"], spans_of(plain)], [old["days"], days_of(plain, since)]
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # at most BUCKETS
    if buckets:
        again = newest_versions(_only(log.where(F.col("bucket").isin(buckets) & F.col("load").isin(held + new)), touched))
        spans.append(spans_of(again))
        days.append(days_of(again, since))
    draft.write(merge_spans(*spans), "spans")
    draft.write(merge_days(since, *days), "days")
    version = draft.commit({"loads": ",".join(sorted(held + new))})
    publish.expire(spark, state_root, keep)
    return version


def state_facts(version: publish.Version, spark: SparkSession, as_of: _dt.date, window_days: int = C.WINDOW_DAYS) -> DataFrame:
    """The frame of ``client_facts``, from the state: (client_code, first_billed,
    last_billed, window_gross, window_rows). The window must lie in the days kept."""
    spans, days = version.read(spark, "spans"), version.read(spark, "days")
    start = as_of - _dt.timedelta(days=window_days)
    window = days.where(F.col("issue_date").between(lit_date(start), lit_date(as_of)))
    sums = window.groupBy(F.col("client_code").alias("_c")).agg(F.sum("gross").cast("decimal(28,2)").alias("window_gross"), F.sum("rows").alias("_rows"))
    joined = spans.join(sums, spans["client_code"].eqNullSafe(sums["_c"]), "left")
    return joined.select("client_code", "first_billed", "last_billed", "window_gross", F.coalesce("_rows", F.lit(0)).cast("long").alias("window_rows"))
