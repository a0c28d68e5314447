"""Sinks. Every write is a whole-job commit through Spark's output committer,
so a failed or re-run task never leaves partial files visible.

* ``write_table``   - overwrite a table (Parquet by default);
* ``write_delimited`` - header-led delimited text (pipe by default);
* ``append_history`` - append-only run history, one partition per run; a
  re-run of the same run replaces only its own partition (idempotent), so a
  retried job cannot duplicate rows;
* ``write_partitioned_by_run_date`` - dated outputs (outbox, delivery log).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .history import register_schema


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> str:
    """Delimited UTF-8 text with a header row; nulls are written as empty fields."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
    return path


def stamp_run(df: DataFrame, run_ts: _dt.datetime, id_col: str = "id") -> DataFrame:
    """Add ``updated_at`` (the run timestamp) and ``run_id``; expose the
    organisation id as ``org_id``."""
    out = df.withColumnRenamed(id_col, "org_id") if id_col in df.columns and id_col != "org_id" else df
    # Wall-clock run time without a zone: reads back identically under any
    # session time zone.
    stamp = F.to_timestamp_ntz(F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")))
    return out.withColumns({"updated_at": stamp, "run_id": F.lit(run_ts.strftime("%Y%m%dT%H%M%S"))})


def append_history(df: DataFrame, path: str, run_ts: _dt.datetime, id_col: str = "id") -> str:
    """Append one run to the history table at ``path`` (partitioned by run).

    Uses dynamic partition overwrite: only the partition of this run is
    (re)written, earlier runs are untouched. Cost is O(rows of this run); the
    history is never read back and rewritten. ``rebalance`` sizes the files of
    the run evenly (AQE splits them by the advisory partition size). The run's
    schema is registered, so that later runs may widen its types."""
    run = stamp_run(df, run_ts, id_col)
    (
        run.hint("rebalance", "run_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
    register_schema(run, path, run_ts.strftime("%Y%m%dT%H%M%S"))
    return path


def history_union(*runs: DataFrame) -> DataFrame:
    """Union of stamped runs by column name; columns missing in a run are null."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def write_partitioned_by_run_date(df: DataFrame, path: str, run_date_col: str = "run_date", fmt: str = "parquet") -> str:
    """Dated output: one partition per run date, replacing only the dates present.

    The ``rebalance`` hint clusters rows by date before the write (few files
    per date instead of one per task and date) and lets AQE split a date that
    holds a large share of the rows into several evenly sized files."""
    (
        df.hint("rebalance", run_date_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(run_date_col)
        .save(path)
    )
    return path
