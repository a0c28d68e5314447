"""Quality classifier (operator 7): a byte-level convolutional network in numpy.

A text's bytes are cut into chunks of 512 that overlap by 64 and together cover
the whole text. Each byte, with a mark if it ends four bytes that also stand up
to 32 bytes before (a filter alone cannot tell that a word repeats, whatever the
word), becomes a learned vector; learned filters of 16 bytes run over the chunk
in steps of 8; each filter's largest response in the chunk is
kept (max-pooling). The mean and the maximum of these over the chunks of the
document, weighted by learned weights, give one probability.

Fitting: a bounded sample of labelled rows, the ``sample_rows`` of smallest
hash of id and no more than ``sample_bytes`` of text (a text that would go over
that is passed over, and later ones are still taken), is collected and fitted on
the driver with Adam (cross-entropy, all chunks of every sampled text). The
sample keeps the natural rate of the labels, so scores are probabilities. The
weights, some 5,000 numbers, travel in the function's closure.

Scoring: one narrow pass over all texts; no shuffle. Long texts are cut into
blocks of chunks; besides a block, a document takes the filters' responses, a
fifth of its bytes.

Defined cases: null and empty texts have no chunk, and get the score of zero
features; without labels of both kinds every score is the share of label 1 (0.5
without any); an id that repeats in the labels counts once, with its smallest
label; rows that repeat are scored alike; null ids are held out; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import forget_tokens, stored, text_slices

CHUNK, STEP, HOP = 512, 448, 8  # bytes of a chunk, between chunks, between filter positions
EMBED, FILTERS = 8, 24
PAD = 256
ECHO = 257  # added to the code of a byte that ends a repeat of four bytes
LAGS = range(2, 33)
SLICE_BYTES = 1 << 18
BLOCK_CHUNKS = 512
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 24 << 20
EPOCHS, RATE, MINIBATCH = 8, 0.01, 32
THRESHOLD = 0.3


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of every chunk, its document); what lies past a text's end is PAD."""
    size = np.diff(offsets)
    count = np.where(size > 0, np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP)), 0)
    doc = np.repeat(np.arange(len(size)), count)
    first = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    left = size[doc] - first
    at = (offsets[doc] + first)[:, None] + np.arange(CHUNK)
    inside = np.arange(CHUNK) < left[:, None]
    if not len(doc):
        return np.zeros((0, CHUNK), np.int16), doc
    raw = data[np.minimum(at, len(data) - 1)]
    echo = np.zeros(raw.shape, bool)
    for lag in LAGS:
        same = raw[:, lag:] == raw[:, :-lag]
        pair = same[:, 1:] & same[:, :-1]
        echo[:, lag + 3 :] |= pair[:, 2:] & pair[:, :-2]
    return np.where(inside, raw + ECHO * echo.astype(np.int16), PAD).astype(np.int16), doc


def blocks_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``chunks_of`` in blocks: a slice of several or short texts as a whole, a
    long text ``BLOCK_CHUNKS`` chunks at a time."""
    if len(offsets) != 2 or len(data) <= SLICE_BYTES:
        yield chunks_of(data, offsets)
        return
    for lo in range(0, len(data) - (CHUNK - STEP), BLOCK_CHUNKS * STEP):
        part = data[lo : lo + (BLOCK_CHUNKS - 1) * STEP + CHUNK]
        yield chunks_of(part, np.array([0, len(part)]))


class Net:
    """Parameters: byte vectors, filters (two halves of 8 bytes), their biases,
    weights of the 2 * FILTERS features of a document, bias."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (2 * ECHO, EMBED)).astype(np.float32),
            "filters": r.normal(0, 0.12, (HOP * EMBED, 2 * FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "b": np.zeros(1, np.float32),
        }
        self.p["embed"][PAD] = 0

    def respond(self, chunks: np.ndarray, where: bool = False):
        """Largest response of each filter in each chunk (and its position)."""
        n = len(chunks)
        blocks = self.p["embed"][chunks].reshape(n * CHUNK // HOP, HOP * EMBED)
        both = (blocks @ self.p["filters"]).reshape(n, CHUNK // HOP, 2 * FILTERS)
        r = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:] + self.p["bias"]
        r *= chunks[:, : -HOP : HOP, None] != PAD  # positions past the end respond with 0
        if not where:
            return np.maximum(r.max(axis=1), 0)
        best = r.argmax(axis=1)
        return np.maximum(np.take_along_axis(r, best[:, None], 1)[:, 0], 0), best, blocks

    def features(self, peaks: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        count = np.bincount(doc, minlength=docs)
        out = np.zeros((docs, 2 * FILTERS), peaks.dtype)
        some = np.flatnonzero(count)
        if len(some):
            heads = np.searchsorted(doc, some)
            out[some, :FILTERS] = np.add.reduceat(peaks, heads, axis=0) / count[some, None]
            out[some, FILTERS:] = np.maximum.reduceat(peaks, heads, axis=0)
        return out

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.p["out"] + self.p["b"]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text of a slice."""
        parts, docs = [np.zeros((0, FILTERS), np.float32)], []
        for chunks, doc in blocks_of(data, offsets):
            parts += [self.respond(chunks[i : i + BLOCK_CHUNKS]) for i in range(0, len(chunks), BLOCK_CHUNKS)]
            docs.append(doc)
        z = self.logits(self.features(np.concatenate(parts), np.concatenate(docs), len(offsets) - 1)).astype(np.float64)
        return 1 / (1 + np.exp(-z))

    def gradients(self, chunks: np.ndarray, doc: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        n, docs = len(chunks), len(labels)
        peaks, best, blocks = self.respond(chunks, where=True)
        f = self.features(peaks, doc, docs)
        dz = ((1 / (1 + np.exp(-self.logits(f))) - labels) / docs).astype(f.dtype)
        df, count = dz[:, None] * self.p["out"], np.bincount(doc, minlength=docs)
        is_max = peaks == f[doc, FILTERS:]
        heads = np.searchsorted(doc, np.arange(docs)[count > 0])
        ties = np.ones((docs, FILTERS), peaks.dtype)
        ties[count > 0] = np.add.reduceat(is_max, heads, axis=0, dtype=peaks.dtype) if len(heads) else 1
        dpeak = df[doc, :FILTERS] / count[doc, None] + df[doc, FILTERS:] * is_max / ties[doc]
        dpeak *= peaks > 0
        dboth = np.zeros((n, CHUNK // HOP, 2 * FILTERS), np.float32)
        c, k = np.arange(n)[:, None], np.arange(FILTERS)[None]
        dboth[c, best, k] = dpeak
        dboth[c, best + 1, k + FILTERS] = dpeak
        flat = dboth.reshape(-1, 2 * FILTERS)
        dblocks = (flat @ self.p["filters"].T).reshape(-1, EMBED)
        which = chunks.ravel()
        dembed = np.stack([np.bincount(which, dblocks[:, e], minlength=2 * ECHO) for e in range(EMBED)], 1).astype(np.float32)
        dembed[PAD] = 0
        return {"embed": dembed, "filters": blocks.T @ flat, "bias": dpeak.sum(0), "out": f.T @ dz, "b": np.array([dz.sum()], np.float32)}


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Net:
    """Fit a network to texts labelled 0 or 1."""
    net, r = Net(seed), np.random.default_rng(seed)
    mean = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    net.p["b"][:] = np.log(mean / (1 - mean))
    if len(set(labels.tolist())) < 2:
        net.p["out"][:] = 0
        return net
    made = [np.concatenate([c for c, _ in blocks_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]))]) for t in texts]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step, steps = 0, epochs * -(-len(texts) // MINIBATCH)
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for lo in range(0, len(order), MINIBATCH):
            pick = order[lo : lo + MINIBATCH]
            doc = np.repeat(np.arange(len(pick)), [len(made[i]) for i in pick])
            grads = net.gradients(np.concatenate([made[i] for i in pick]), doc, labels[pick].astype(np.float32))
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32, as text, is divisible by 5; null counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, size: int) -> tuple[list[bytes], np.ndarray]:
    """The labelled, not held-out rows of smallest hash, at most ``rows`` of them
    and ``size`` bytes of text; a text that would go over that is passed over."""
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("int").alias("__label"))
    # At most `rows` ids are broadcast.
    ids = known.withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id").limit(rows)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    joined = docs.select(F.col(id_col).alias("__id"), text.alias("__text")).join(F.broadcast(ids), "__id")
    joined = stored(joined.withColumn("__size", F.octet_length("__text").cast("long")), "quality-sample")
    sizes = sorted((r[0], r[1], r[2]) for r in joined.groupBy("__h", "__id").agg(F.max("__size")).collect())
    total, pick = 0, []
    for h, _, n in sizes:
        if total + n <= size:
            total += n
            pick.append((h,))
    if not pick:
        return [], np.zeros(0)
    wanted = docs.sparkSession.createDataFrame(pick, "__h long").distinct()
    got = joined.join(F.broadcast(wanted), "__h").groupBy("__h", "__id").agg(F.min("__text").alias("__text"), F.min("__label").alias("__label")).orderBy("__h", "__id").collect()
    return [bytes(r["__text"]) for r in got], np.array([r["__label"] for r in got], np.float64)


def scorer(net: Net) -> Callable[[Column], Column]:
    """The network as a function of a text column. Only the text visits Python."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        forget_tokens()
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        parts = [net.score(data, off) for _, _, data, off in text_slices(batch, "text", SLICE_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Net:
    """A network fitted to the labelled rows that are not held out."""
    return fit(*training_sample(docs, labels, id_col, text_col, label_col, sample_rows, sample_bytes))


def quality_scores(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(<id_col>, held_out, score, predicted)`` of every row of ``docs``."""
    scored = docs.select(F.col(id_col), scorer(net)(F.col(text_col)).alias("score"))
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
