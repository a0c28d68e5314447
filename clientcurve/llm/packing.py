"""Packing (operator 10): mixture-controlled windows by deficit round-robin.

Sources are queues of tokens. Every window of ``window`` tokens grants each queue its
target proportion (its weight; by default its share of all tokens, so that all
queues run dry together) plus the deficit that it carries, and takes exactly that
many tokens from the queue's head, cutting documents where need be. What a grant
leaves over, less than a token, is carried to the next window: after w windows a
queue has given its share of w windows to within one token, and so a single window
holds each share to within two.

Grants have a closed form, so no state has to pass through one task. Let queue j
have the weight k[j] and K[j] = k[0] + ... + k[j]. Queues 0 to j together give
P[j](w) = floor(w * window * K[j] / K) tokens to the first w windows, so queue j alone
gives P[j](w) - P[j-1](w), its part of window w begins at the offset
P[j-1](w+1) - P[j-1](w), and the window is exactly full. A document knows its windows
from the tokens of its source before it, a distributed running sum. The deficits
with which a partition begins are thus in its documents' places.

Where a queue runs dry (weights of one's own) the windows so far are a *phase*; one
window takes what is left of that queue and shares the rest out, and a new phase
begins with the others' weights. The plan, a few numbers a phase and queue, is made on
the driver from the queues' totals. The last window is closed with sequences of
power-of-two lengths, so nothing is padded.

Queues granted less than ``quantum`` tokens a window by the plan's first phase (at
least one) would give a window nothing, or crumbs; such sources are one queue, in
which their documents stand by the time at which each source would have given them.
So there are at most ``window`` queues, however many sources.

Document ids are stored once and shuffled once; the plan moves only numbers. A window
has a piece of every queue, so there are about windows * queues + documents pieces.

Defined cases: a null text is empty, so the document has only the end id; a null
source is a source; rows that repeat an id are separate documents; a queue's order
is by id (null first), then stored row; a source without a positive weight comes
when all others have run dry; an empty table gives no pieces; other columns are not
read.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped, pinned, running_offsets, stored
from ._tokens import encoder, id_bytes

WINDOW = 4096


def tokenized(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, source_col: str, end_id: int | None) -> DataFrame:
    """``(row, id, source, n, ids)``: the ids of each document, end id included,
    as little-endian values of the tokenizer's width. ``row`` numbers the rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    source_type = rows.schema["source"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        enc, end = encoder(tokenizer), b""
        if end_id is not None:
            end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype().itemsize
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [enc.encode(t.as_py() or "") + end for t in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(ids))),
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) // width for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["row", "id", "source", "n", "ids"],
                )
                row += len(ids)

    return stored(mapped(rows, run, f"row long, id {id_type}, source {source_type}, n long, ids binary", tokens=True), "pack-ids")


@dataclass(frozen=True)
class Phase:
    """Windows ``first`` to ``first + windows - 1``. ``given``: what each queue has
    given before. Even phases have cumulative weights ``upto`` (K above); others are
    one window, full or the last, with a count for each queue."""

    first: int
    windows: int
    given: list[int]
    upto: list[int] | None = None
    counts: list[int] | None = None

    def before(self, j: np.ndarray, w: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens that the queues before j, and those up to j, give to the first
        ``w`` windows of the phase)."""
        if self.counts is not None:
            ends = np.cumsum([0, *self.counts])
            return np.where(w > 0, ends[j], 0), np.where(w > 0, ends[j + 1], 0)
        total = self.upto[-1]
        exact = np.int64 if self.windows * window * total < 2**62 else object
        upto = np.array([0, *self.upto], exact)
        w = w.astype(exact) * window
        return (w * upto[j] // total).astype(np.int64), (w * upto[j + 1] // total).astype(np.int64)


def phases(sizes: list[int], weights: list[int], window: int) -> list[Phase]:
    """The plan for queues of these sizes: grants by weight while every queue of a
    positive weight lasts, then by the weights of those that do; queues without
    weight last, by size."""
    left, out, at = list(sizes), [], 0

    def put(windows: int, upto=None, counts=None):
        nonlocal at
        phase = Phase(at, windows, [n - x for n, x in zip(sizes, left, strict=True)], upto, counts)
        out.append(phase)
        gone = counts
        if upto is not None:
            low, high = phase.before(np.arange(len(sizes)), np.full(len(sizes), windows), window)
            gone = (high - low).tolist()
        left[:] = [x - g for x, g in zip(left, gone, strict=True)]
        at += windows

    while sum(left):
        k = [w if x else 0 for w, x in zip(weights, left, strict=True)]
        if not sum(k):
            k = left[:]
        total = sum(k)
        whole = min(x * total // (window * w) for x, w in zip(left, k, strict=True) if w)
        whole = min(whole, sum(left) // window)
        if whole:
            put(whole, upto=list(itertools.accumulate(k)))
        elif sum(left) <= window:
            put(1, counts=left[:])
        else:  # a queue ends inside this window: all of it, and the others' shares of what is free
            counts, free = [0] * len(left), window
            open_ = [j for j, w in enumerate(k) if w]
            while free:
                if not open_:
                    open_ = [j for j, x in enumerate(left) if x > counts[j]]
                    k = left
                total = sum(k[j] for j in open_)
                ends = list(itertools.accumulate(k[j] for j in open_))
                share = [free * e // total - free * (e - k[j]) // total for j, e in zip(open_, ends, strict=True)]
                for j, n in zip(open_, share, strict=True):
                    counts[j] += min(n, left[j] - counts[j])
                free = window - sum(counts)
                open_ = [j for j in open_ if left[j] > counts[j]]
            put(1, counts=counts)
    return out


def pieces_of(queue: np.ndarray, begin: np.ndarray, size: np.ndarray, plan: list[Phase], sizes: list[int], window: int):
    """(document, first token, length, window, offset) of the pieces of documents
    that stand at ``begin`` in their queues."""
    out = []
    for i, phase in enumerate(plan):
        start = np.array(phase.given, np.int64)
        stop = np.array(plan[i + 1].given if i + 1 < len(plan) else sizes, np.int64)
        lo, hi = np.maximum(begin, start[queue]), np.minimum(begin + size, stop[queue])
        doc = np.flatnonzero(lo < hi)
        if not len(doc):
            continue
        j, lo, hi = queue[doc], lo[doc] - start[queue[doc]], hi[doc] - start[queue[doc]]

        def given(w, j, phase=phase):
            low, high = phase.before(j, w, window)
            return high - low

        def window_of(x, j, phase=phase, given=given):
            """The window that takes the queue's token x of the phase."""
            own = np.maximum(given(np.full(len(j), phase.windows), j), 1)
            w = np.clip((x / own * phase.windows).astype(np.int64), 0, phase.windows - 1)
            while (late := given(w, j) > x).any():
                w = w - late
            while (early := given(w + 1, j) <= x).any():
                w = w + early
            return w

        w0, w1 = window_of(lo, j), window_of(hi - 1, j)
        n = w1 - w0 + 1
        at = np.repeat(np.arange(len(doc)), n)
        w = np.repeat(w0, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        j, lo, hi, d = j[at], lo[at], hi[at], doc[at]
        low, high = phase.before(j, w, window)
        low_next, high_next = phase.before(j, w + 1, window)
        a, z = np.maximum(lo, high - low), np.minimum(hi, high_next - low_next)
        some = a < z
        first = a + start[j] - begin[d]
        out.append(tuple(v[some] for v in (d, first, z - a, phase.first + w, low_next - low + a - (high - low))))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    doc, first, length, w, off = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((first, doc))
    return doc[order], first[order], length[order], w[order], off[order]


def _queues(tokens: DataFrame, window: int, quantum: int, weights: DataFrame | None) -> tuple[DataFrame, dict, list[int], list[int]]:
    """(sources with their sizes, rates and whether they have a queue of their own;
    queue of each of these; sizes and weights of the queues, the common one first)."""
    totals = tokens.groupBy("source").agg(F.sum("n").alias("size"))
    if weights is None:
        totals = totals.withColumn("rate", F.col("size").cast("double"))
    else:
        own = weights.groupBy(F.col("source").alias("s")).agg(F.sum("weight").cast("double").alias("rate"))
        totals = totals.join(own, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("rate", F.greatest(F.coalesce("rate", F.lit(0.0)), F.lit(0.0)))
    totals = pinned(totals.where("size > 0"))
    every = totals.agg(F.sum("rate").alias("rate"), F.sum("size").alias("size")).first()
    if not every["size"]:
        return totals.withColumn("own", F.lit(True)), {}, [], []
    # Sources without weight have their turn by size.
    part = F.when(F.col("rate") > 0, F.col("rate") / (every["rate"] or 1.0)).otherwise(F.col("size") / F.lit(float(every["size"])))
    totals = totals.withColumn("own", part * window >= max(1, quantum))
    big = totals.where("own").orderBy(F.col("source").asc_nulls_first()).collect()  # at most 2 * window rows
    rest = totals.where("NOT own").agg(F.sum("size").alias("size"), F.sum("rate").alias("rate")).first()
    unit = 1 if weights is None else 2**40 / (every["rate"] or 1.0)
    sizes = [rest["size"] or 0, *[r["size"] for r in big]]
    rates = [rest["rate"] or 0.0, *[r["rate"] for r in big]]
    return totals, {r["source"]: i + 1 for i, r in enumerate(big)}, sizes, [max(1, round(r * unit)) if r else 0 for r in rates]


def _places(tokens: DataFrame, totals: DataFrame) -> DataFrame:
    """``(row, begin)``: tokens before each document in its queue."""
    queue = running_offsets(tokens.select("row", "id", "source", "n"), ["source"], ["id", "row"], "n", "begin")
    if totals.where("NOT own").isEmpty():
        return queue.select("row", "begin")
    t = totals.select(F.col("source").alias("s"), "own", "size", "rate")
    queue = pinned(queue.join(t, F.col("source").eqNullSafe(F.col("s"))).select("row", "source", "n", "begin", "own", ((F.col("begin") + F.col("n")) / F.when(F.col("rate") > 0, F.col("rate")).otherwise(F.col("size"))).alias("leaves"), (F.col("rate") > 0).cast("int").alias("late")))
    rest = queue.where("NOT own").select("row", "source", "n", (1 - F.col("late")).alias("late"), "leaves")
    rest = running_offsets(rest, [], ["late", "leaves", "source", "row"], "n", "begin")
    return queue.where("own").select("row", "begin").unionByName(rest.select("row", "begin"))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    end_id: int | None = None,
    window: int = WINDOW,
    quantum: int = 1,
    weights: DataFrame | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of a document: ``(<id_col>, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, source[, ids])``; ``ids`` are
    unsigned 32-bit little endian. ``weights(source, weight)`` are the target
    proportions: sources that run dry leave their share to the others."""
    if quantum > window:
        raise ValueError("a quantum may not exceed the window")
    tokens = tokenized(docs, tokenizer, id_col, text_col, source_col, end_id)
    totals, names, sizes, rates = _queues(tokens, window, quantum, weights)
    plan = phases(sizes, rates, window)
    full, tail = divmod(sum(sizes), window)
    # The rest of the tokens: one sequence for each binary digit of their number.
    cuts = np.cumsum([0, *[1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]])
    joined = tokens.join(_places(tokens, totals), "row").select("id", "source", "n", "ids", "begin")
    id_type = tokens.schema["id"].dataType.simpleString()
    source_type = tokens.schema["source"].dataType.simpleString()
    width = 2 if id_bytes(tokenizer) == 2 else 4

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                queue = np.array([names.get(x, 0) for x in part.column(1).to_pylist()], np.int64)
                n, begin = part.column(2).to_numpy(), part.column(4).to_numpy()
                owner, first, length, seq, off = pieces_of(queue, begin, n, plan, sizes, window)
                late = seq >= full
                if late.any():  # the last window's pieces, cut again at its sequences
                    owner, first, length, seq, off = (np.concatenate([v[~late], x]) for v, x in zip((owner, first, length, seq, off), _tail(owner[late], first[late], length[late], off[late], full, cuts), strict=True))
                values = [np.frombuffer(x.as_buffer(), np.dtype(f"<u{width}")).astype("<u4") for x in part.column(3)]
                pieces = [values[o][s : s + m] for o, s, m in zip(owner, first, length, strict=True)]
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(take),
                        pa.array(first),
                        pa.array(length),
                        pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                        part.column(2).take(take),
                        pa.array(seq),
                        pa.array(off),
                        part.column(1).take(take),
                        pa.array([p.tobytes() if with_ids else None for p in pieces], pa.binary()),
                    ],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"],
                )

    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source {source_type}, ids binary"
    pieces = mapped(joined, run, schema).withColumnRenamed("id", id_col)
    return pieces if with_ids else pieces.drop("ids")


def _tail(owner, first, length, off, full, cuts):
    """Pieces of the last window as pieces of its sequences, ``cuts`` being where
    these begin and end. There are at most as many as the window's length has bits."""
    out = []
    for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        lo, hi = np.maximum(off, a), np.minimum(off + length, z)
        some = lo < hi
        out.append((owner[some], (first + lo - off)[some], (hi - lo)[some], np.full(some.sum(), full + i), (lo - a)[some]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
