"""Helpers shared by the training-data operators: stored intermediates,
byte slices of Arrow text columns and streaming over sorted groups."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientcurve.session import delete_path, ensure_checkpoint_dir, shared_path


BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """Stored tables that are done with once a later table is stored."""

    def __init__(self, spark):
        self._spark, self.paths = spark, []

    def remove(self) -> None:
        for path in self.paths:
            delete_path(self._spark, path)
        self.paths.clear()


def stored(df: DataFrame, name: str, compression: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends at files that survive the loss of any executor. With ``scratch``,
    the files go when that is removed."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if scratch is not None:
        scratch.paths.append(path)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small table (removed with its last reference
    where the cluster cleans checkpoints)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_memory() -> None:
    """Give back to the system what this worker has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def forget_tokens() -> None:
    """Drop what tokenizing tasks have cached in this worker."""
    from . import _tokens

    if _tokens.release():
        release_memory()


def lean(run, tokens: bool = False):
    """A task's function for a worker that Spark keeps for later tasks: what
    tokenizing tasks have cached goes before it starts, unless it tokenizes itself,
    and freed memory goes back to the system when it ends."""

    def task(batches):
        if not tokens:
            forget_tokens()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def mapped(df: DataFrame, run, schema, tokens: bool = False) -> DataFrame:
    """``df.mapInArrow`` by a lean task, in Arrow batches of bounded bytes."""
    return df.mapInArrow(lean(run, tokens), schema)


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into slices of about ``max_bytes`` of UTF-8 text (at least
    one row each). Yields (first row, row count, bytes, offsets); null texts
    are empty."""
    arr = batch.column(batch.schema.get_field_index(column))
    n = len(arr)
    if not n:
        return
    if arr.null_count:
        arr = arr.fill_null("" if not pa.types.is_binary(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi - lo, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from batches sorted by ``keys`` (one group is held
    at a time, never a whole partition)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is not None and any(c[0].as_py() != v for c, v in zip(cols, last, strict=True))
        for c in cols:
            v = c.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        lo = 0
        for cut in cuts:
            if cut > lo:
                held.append(batch.slice(lo, cut - lo))
            if held:
                yield pa.Table.from_batches(held)
            held, lo = [], cut
        held.append(batch.slice(lo))
        last = [c[len(c) - 1].as_py() for c in cols]
    if held:
        yield pa.Table.from_batches(held)


def running_offsets(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` in each ``group`` by ``order``, with no
    global window: rows are range-partitioned on (group, order), each task sums
    its own range in a stream, and the totals of (range, group), a table of at
    most ranges + groups rows, carry the sums from range to range. The order
    must be total or its ties interchangeable. A group of any size spreads over
    many ranges. The ranged table is pinned: bounds come from a sample and must
    not be drawn again."""
    spark = df.sparkSession
    keys = [*group, *order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in keys]).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in keys]
    )
    schema = ranged.select("*", F.lit(0).cast("int").alias("__range"), F.lit(0).cast("long").alias(out)).schema

    def sums(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, total = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.cumsum(v) - v
            new = np.zeros(n, bool)
            first = tuple(b.column(b.schema.get_field_index(g))[0].as_py() for g in group)
            for g in group:
                c = b.column(b.schema.get_field_index(g))
                valid = c.is_valid().to_numpy(zero_copy_only=False)
                new[1:] |= valid[1:] != valid[:-1]
                same = pa.compute.equal(c.slice(1), c.slice(0, n - 1)).fill_null(True) if n > 1 else None
                if same is not None:
                    new[1:] |= ~same.to_numpy(zero_copy_only=False)
            new[0] = last is not None and first != last
            carried = 0 if new[0] or last is None else total
            starts = np.flatnonzero(new) if new[0] else np.concatenate([[0], np.flatnonzero(new)])
            base = np.repeat(run[starts], np.diff(np.append(starts, n)))
            run = run - base
            run[: starts[1] if len(starts) > 1 else n] += carried
            total = int(run[-1] + v[-1])
            last = tuple(b.column(b.schema.get_field_index(g))[n - 1].as_py() for g in group)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, pid, np.int32)), pa.array(run)], names=[*b.schema.names, "__range", out]
            )

    local = pinned(mapped(ranged, sums, schema))
    totals = local.groupBy("__range", *group).agg(F.sum(value).cast("long").alias("__sum"))
    from pyspark.sql import Window

    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        F.col("__range").alias("__r"),
        *[F.col(g).alias(f"__g_{g}") for g in group],
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__carry"),
    )
    on = F.col("__range") == F.col("__r")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return local.join(carry, on).select(*df.columns, (F.col(out) + F.col("__carry")).alias(out))


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, parts: int, scratch: Scratch | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``table``, one row a key, whose ``weight`` counts
    the key's rows. The 4 * ``parts`` heaviest keys are broadcast, so that their rows
    stay where they are; the others, each less than a quarter of a partition's even
    share of the rows, meet by a shuffle."""
    spark = rows.sparkSession
    table = stored(table, "join-keys", scratch=scratch)
    heavy = table.orderBy(F.col(weight).desc(), *keys).limit(4 * parts).collect()
    if not heavy:
        return rows.join(table, keys)
    heavy = F.broadcast(spark.createDataFrame(heavy, table.schema))
    rest = rows.join(heavy.select(*keys), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(table, keys))


def ship(spark) -> None:
    """Send the package's source to the executors, for sessions that were not
    started with it on their Python path (once for a context), and bound the bytes
    of an Arrow batch: 10,000 rows of text are any number of bytes."""
    sc = spark.sparkContext
    size = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(_BATCH_KEY).strip().lower())
    if size is None or int(size[1]) << 10 * " kmgt".index(size[2] or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)
    if getattr(sc, "_clientcurve_shipped", False):
        return
    import os
    import tempfile
    import zipfile

    import clientcurve

    root = os.path.dirname(os.path.abspath(clientcurve.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="clientcurve-src-"), "clientcurve_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._clientcurve_shipped = True
