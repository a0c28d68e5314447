"""Hard-negative mining (operator 13): anchor-clustered shared lists.

An anchor's positives are its best rows of the same label; for each positive of
score p, its hard negatives are the best rows of another label with
``low * p <= high * score <= high * p``. Scores are inner products of whole
numbers, floor(scale * x).

Anchors are clustered by angle. For a cluster with centre c, whose members lie
within an angle b of c, no member q can score a row x, at an angle t from c, above
|q| |x| cos(max(0, t - b)). So the rows of a shard are sorted once a cluster by
|x| cos(max(0, t - b)), and every member walks that one list from its top, scoring
a stretch at a time, until what it still needs is certainly out of reach: its own
k-th best score, or, for negatives, the lowest score in the band, exceeds what the
next bound allows. The answer is exact, however well the clusters fit.

Positives must be known before their bands are, so there are two walks: one for
positives, merged over the shards, and one for the negatives of all positives of
an anchor together.

Anchors stand in blocks of about ``BLOCK_ROWS``: whole clusters, or parts of a large
one; rows are dealt to shards by a hash of their id. Each pair of block and shard is
one task's work of bounded size. Up to ``CENTRES`` centres are fitted on at most
``SAMPLE_ROWS`` anchors; they decide only how early walks end.

Defined cases: rows with a null id, label or vector, an empty vector, or a null or
non-finite component take no part; a repeated id is one row, that of the smallest
(vector, label); copies of a vector are rows like others, ties go to the smaller
id; vectors of different lengths are not compared; scores beyond the range of a
long are clipped to it, and clipped scores of positives set the bands; an empty
table, and anchors without positives or negatives, give no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import mapped, stored
from ._vectors import usable

SHARD_VALUES, BLOCK_ROWS = 1 << 19, 1024
CENTRES, ANCHORS_A_CENTRE = 256, 64
SAMPLE_ROWS, SAMPLE_VALUES = 8192, 1 << 20
STRETCH = 512
_LONG = np.iinfo(np.int64)


# ------------------------------------------------------------------ clusters
def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1; zero vectors stay."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def centres(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the start is spread by the farthest point."""
    points = unit(points)
    chosen = [points[0]]
    near = points @ points[0]
    while len(chosen) < count:
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(points[far])
        near = np.maximum(near, points @ points[far])
    c = np.array(chosen)
    for _ in range(rounds):
        own = (points @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, points)
        c = np.where((sums != 0).any(axis=1, keepdims=True), unit(sums), c)
    return c


def list_bounds(x: np.ndarray, members: np.ndarray) -> np.ndarray:
    """What a member of length 1 can score with each row at most."""
    u = unit(members)
    c = unit(u.sum(axis=0, keepdims=True))[0]
    # Angles carry rounding errors of about 1e-8 near 0 and pi; the slack covers them.
    spread = np.arccos(np.clip(u @ c, -1, 1)).max() + 1e-6
    angle = np.arccos(np.clip(unit(x) @ c, -1, 1))
    top = np.abs(x).max(axis=1)
    length = top * np.sqrt(((x / np.maximum(top, 1e-300)[:, None]) ** 2).sum(axis=1))
    return length * np.cos(np.clip(angle - spread, 0, np.pi)) + length * 1e-9


# ------------------------------------------------------------------ walks
class _Kept:
    """The ``k`` best (score, id) of each slot, ties to the smaller id."""

    def __init__(self, slots: int, k: int):
        self.score = np.full((slots, k), -np.inf)
        self.id = np.full((slots, k), _LONG.max, np.int64)

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows of ``scores`` belong to ``slots``; -inf where a row is not wanted."""
        some = (scores >= self.score[slots, -1][:, None]).any(axis=1) & (scores > -np.inf).any(axis=1)
        slots, scores = slots[some], scores[some]
        if not len(slots):
            return
        k = self.score.shape[1]
        s = np.concatenate([self.score[slots], scores], axis=1)
        i = np.concatenate([self.id[slots], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        self.score[slots] = np.take_along_axis(s, order, 1)
        self.id[slots] = np.take_along_axis(i, order, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, id, score) of all kept rows."""
        slot, col = np.nonzero(self.score > -np.inf)
        return slot, self.id[slot, col], self.score[slot, col].astype(np.int64)


def walk(ids, x, labels, qids, q, qlabels, k, bands=None, low=80, high=100, stretch=STRETCH):
    """One cluster's walk down its list over one shard. Without ``bands``: the ``k``
    best rows of a member's label, slots being members. With ``bands``, positive
    scores by member, padded with -1: the ``k`` best rows of another label in each
    band, slots being member * bands + band. Also returns the rows scored."""
    bound = list_bounds(x, q)
    order = np.lexsort((ids, -bound))
    bound, ids, x, labels = bound[order], ids[order], x[order], labels[order]
    norm = np.sqrt((q * q).sum(axis=1))
    width = 1 if bands is None else bands.shape[1]
    kept = _Kept(len(q) * width, k)
    floor = np.full((len(q), width), -np.inf)
    if bands is not None:  # the smallest whole number in a band; none in a negative one
        floor = np.where(bands < 0, np.inf, -((-low * bands) // high))
    live, scored = np.arange(len(q)), 0
    for lo in range(0, len(ids), stretch):
        need = np.maximum(floor, kept.score[:, -1].reshape(len(q), width))[live].min(axis=1)
        live = live[bound[lo] * norm[live] * (1 + 1e-9) + 1 >= need]
        if not len(live):
            break
        part = slice(lo, lo + stretch)
        s = q[live] @ x[part].T
        scored += s.size
        same = labels[part] == qlabels[live][:, None]
        if bands is None:
            kept.add(live, np.where(same & (ids[part] != qids[live][:, None]), s, -np.inf), ids[part])
            continue
        whole = s.astype(np.int64)
        for b in range(width):
            p = bands[live, b][:, None]
            fits = ~same & (p >= 0) & (low * p <= high * whole) & (whole <= p)
            kept.add(live * width + b, np.where(fits, s, -np.inf), ids[part])
    return *kept.found(), scored


def _plain(ids, x, labels, qids, q, qlabels, k, bands=None, low=80, high=100):
    """The same, for values too large for exact doubles: whole numbers of any size,
    one row after another, without a list."""
    rows = [[int(v) for v in r] for r in x]
    slots, found, scores = [], [], []
    for i, mine in enumerate([[int(v) for v in r] for r in q]):
        own = sorted((-max(_LONG.min, min(_LONG.max, sum(a * b for a, b in zip(mine, r, strict=True)))), int(d), int(lab)) for d, r, lab in zip(ids, rows, labels, strict=True))
        for b, p in enumerate([None] if bands is None else bands[i].tolist()):
            good = [(s, d) for s, d, lab in own if (lab == qlabels[i] and d != qids[i] if p is None else lab != qlabels[i] and p >= 0 and low * p <= -high * s <= high * p)]
            for s, d in good[:k]:
                slots.append(i if bands is None else i * bands.shape[1] + b)
                found.append(d)
                scores.append(-s)
    return np.array(slots, np.int64), np.array(found, np.int64), np.array(scores, np.int64), 0


def _numbers(table: pa.Table, scale: int) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat.reshape(table.num_rows, -1))


def _walks(a: pa.Table, b: pa.Table, scale: int, k: int, bands=None, low=80, high=100):
    """Walks of all clusters of one block over one shard; yields (anchors' places
    in ``b``, slot, id, score)."""
    ids, x, labels = a.column("id").to_numpy(), _numbers(a, scale), a.column("label").to_numpy()
    qids, q, qlabels, cluster = b.column("id").to_numpy(), _numbers(b, scale), b.column("label").to_numpy(), b.column("cluster").to_numpy()
    exact = 4 * np.abs(x).max() * np.abs(q).max() * x.shape[1] < 2.0**53
    for c in np.unique(cluster):
        at = np.flatnonzero(cluster == c)
        own = None if bands is None else bands[at]
        yield at, *(walk if exact else _plain)(ids, x, labels, qids[at], q[at], qlabels[at], k, own, low, high)[:3]


# ------------------------------------------------------------------ the operator
def _clustered(anchors: DataFrame, count: int) -> tuple[DataFrame, list[int], list[int], int]:
    """Anchors with their cluster, and for each cluster its first block and how many
    blocks it fills; the number of blocks."""
    sample = anchors.select("vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toLocalIterator()
    fit, values, dim = [], 0, None
    for r in sample:  # of one length, up to SAMPLE_VALUES numbers
        dim = dim or len(r["vec"])
        values += dim
        if values > SAMPLE_VALUES and fit:
            break
        if len(r["vec"]) == dim:
            fit.append(r["vec"])
    c = centres(np.array(fit, np.float64), max(1, min(CENTRES, count // ANCHORS_A_CENTRE)))

    def run(batches):
        for b in batches:
            vecs = b.column(b.schema.get_field_index("vec"))
            own = np.zeros(b.num_rows, np.int32)
            sizes = np.diff(vecs.offsets.to_numpy())
            fits = np.flatnonzero(sizes == c.shape[1])
            if len(fits):
                flat = vecs.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                own[fits] = (unit(flat.reshape(len(fits), -1)) @ c.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own)], names=[*b.schema.names, "cluster"])

    schema = anchors.select("*", F.lit(0).cast("int").alias("cluster")).schema
    placed = stored(mapped(anchors, run, schema), "negatives-anchors")
    sizes = dict.fromkeys(range(len(c)), 0) | {r["cluster"]: r["count"] for r in placed.groupBy("cluster").count().collect()}
    first, parts, block, room = [], [], 0, BLOCK_ROWS
    for i in range(len(c)):
        if sizes[i] > room and room < BLOCK_ROWS:
            block, room = block + 1, BLOCK_ROWS
        first.append(block)
        parts.append(max(1, -(-sizes[i] // BLOCK_ROWS)))
        if parts[-1] > 1:
            block, room = block + parts[-1], BLOCK_ROWS
        else:
            room -= sizes[i]
    return placed, first, parts, max(f + p for f, p in zip(first, parts, strict=True))


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    k: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``. ``anchor`` and ``label`` are expressions of ``id`` and of the
    table's columns; the label is its ``label`` unless given."""
    spark = vectors.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.withColumn("__id", F.col(id_col).cast("long"))
    rows = rows.select(F.col("__id").alias("id"), F.col(vec_col).alias("vec"), (F.col("label") if label is None else label).cast("long").alias("label"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    rows = rows.groupBy("id").agg(F.min(F.struct("vec", "label")).alias("row")).select("id", "row.vec", "row.label")
    rows = stored(rows.withColumn("dim", F.size("vec")), "negatives-rows")
    anchors = rows.where(anchor)
    size = rows.agg(F.count("*").alias("n"), F.count_if(anchor).alias("q"), F.max("dim").alias("dim")).first()
    if not size["q"]:
        return spark.createDataFrame([], empty)
    shards = max(1, -(-size["n"] * size["dim"] // SHARD_VALUES))
    placed, first, parts, blocks = _clustered(anchors, size["q"])

    def nth(numbers: list[int]) -> Column:
        return F.get(F.array(*[F.lit(int(x)) for x in numbers]), F.col("cluster"))

    placed = placed.withColumn("block", nth(first) + F.pmod(F.xxhash64("id"), nth(parts)).cast("int"))
    left = rows.select("id", "vec", "label", "dim", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = placed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["shard", "block", "dim"]

    def table(parts: list, names: list[str]) -> pa.Table:
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=names)

    def best_positives(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            qids = b.column("id").to_numpy()
            out = [(qids[at][slot], found, score) for at, slot, found, score in _walks(a, b, scale, positives)]
        return table(out, ["anchor_id", "positive_id", "positive_score"])

    def best_negatives(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            qids = b.column("id").to_numpy()
            bands, which = np.full((b.num_rows, positives), -1, np.int64), np.zeros((b.num_rows, positives), np.int64)
            for i, own in enumerate(b.column("positives").to_pylist()):
                for j, p in enumerate(own):
                    bands[i, j], which[i, j] = p["positive_score"], p["positive_id"]
            for at, slot, found, score in _walks(a, b, scale, k, bands, low, high):
                member, band = at[slot // positives], slot % positives
                out.append((qids[member], which[member, band], bands[member, band], found, score))
        return table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_positives, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= positives)
    mine = found.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    mine = stored(mine, "negatives-positives")  # at most `positives` an anchor
    banded = right.join(mine, "id")
    found = left.groupBy(*keys).cogroup(banded.groupBy(*keys)).applyInArrow(best_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
