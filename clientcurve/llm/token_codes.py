"""Token-ID / binary output (operator 3): directly addressable codes.

An id is split into chunks of 8 bits, lowest first. Level 0 has the first chunk
of every id, and a continuation bitmap that marks the ids that go on; level 1
has the second chunk of those, and so on. A rank directory holds, for every 512
bits of a bitmap, the marks before them. So the chunk of token i on the next
level stands at rank(i), and any token is read in a few byte reads, with no
block to decode; a range of tokens is a range on every level.

Format of one segment (little endian):

    "DAC1"  u32 levels  u64 tokens
    for each level: u64 count, u64 place of its chunks, of its bitmap, of its directory
    chunks (u8), bitmaps (lowest bit first), directories (u64)

A dataset is a Parquet table of segments: Spark writes and commits it, so a lost
executor leaves no half file, and it can lie wherever Spark can write.

    part, seg      order of the segments; documents stand in ascending id order
    tokens         ids in the segment
    ids, lengths   the documents of the segment and their ids' counts
    codes          the segment

Documents are range-partitioned on (id, hash of text), so that one repeated id
cannot fill a task, and are encoded in that order; a segment closes at
``segment_tokens``.

Defined cases: a null text is empty (the document has only the end id); null ids
come first; rows that repeat an id are separate documents, ordered by the hash
of their texts; an empty table gives an empty dataset; other columns are not
read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import mapped
from ._tokens import encoder

MAGIC = b"DAC1"
BLOCK = 512


def encode_segment(ids: np.ndarray) -> bytes:
    levels = []
    rest = ids.astype(np.uint64)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // BLOCK) * BLOCK // 8, np.uint8)
        padded[: len(bits)] = bits
        per_block = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint64)
        directory = np.cumsum(per_block, dtype=np.uint64) - per_block
        levels.append((len(rest), (rest & np.uint64(255)).astype(np.uint8).tobytes(), padded.tobytes(), directory.astype("<u8").tobytes()))
        if not more.any():
            break
        rest = rest[more] >> np.uint64(8)
    place = 16 + 32 * len(levels)
    head, body = [MAGIC + struct.pack("<IQ", len(levels), len(ids))], []
    for count, *parts in levels:
        at = []
        for p in parts:
            at.append(place)
            place += len(p)
            body.append(p)
        head.append(struct.pack("<QQQQ", count, *at))
    return b"".join(head + body)


class DirectCodes:
    """Reader of one segment."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        levels, self.tokens = struct.unpack_from("<IQ", blob, 4)
        self._levels = []
        for i in range(levels):
            count, chunks, bits, directory = struct.unpack_from("<QQQQ", blob, 16 + 32 * i)
            blocks = -(-count // BLOCK)
            self._levels.append(
                (
                    np.frombuffer(blob, np.uint8, count, chunks),
                    np.frombuffer(blob, np.uint8, blocks * BLOCK // 8, bits),
                    np.frombuffer(blob, "<u8", blocks, directory),
                )
            )

    def __len__(self) -> int:
        return self.tokens

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Marks before position i."""
        block, rest = divmod(i, BLOCK)
        if block == len(directory):
            block, rest = block - 1, BLOCK
        if block < 0:
            return 0
        at = block * BLOCK // 8
        whole = int(np.bitwise_count(bits[at : at + rest // 8]).sum())
        last = int(bits[at + rest // 8]) & ((1 << rest % 8) - 1) if rest % 8 else 0
        return int(directory[block]) + whole + last.bit_count()

    def get(self, i: int) -> int:
        """Token i."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, directory) in enumerate(self._levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bits, directory, i)
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b as u32."""
        out = np.zeros(b - a, np.uint32)
        where = None
        for level, (chunks, bits, directory) in enumerate(self._levels):
            if a >= b:
                break
            part = chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            if where is None:
                out |= part
                where = np.arange(b - a)
            else:
                out[where] |= part
            more = np.unpackbits(bits[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a].astype(bool)
            where = where[more]
            a = self._rank(bits, directory, a)
            b = a + len(where)
        return out


def write_codes(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    segment_tokens: int = 1 << 18,
) -> None:
    """Encode every text and write the dataset at ``path`` (which must be new)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        part, seg = TaskContext.get().partitionId(), 0
        enc, end = encoder(tokenizer), b""
        if end_id is not None:
            end = np.array([end_id], enc.dtype).tobytes()
        held, lengths, keys, size = [], [], [], 0
        ids_type = None

        def flush():
            ids = np.frombuffer(b"".join(held), enc.dtype)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seg], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([keys], pa.list_(ids_type)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([encode_segment(ids)], pa.binary()),
                ],
                names=["part", "seg", "tokens", "ids", "lengths", "codes"],
            )

        for batch in batches:
            ids_type = batch.column(0).type
            for k, text in zip(batch.column(0), batch.column(2), strict=True):
                ids = enc.encode(text.as_py() or "") + end
                n = len(ids) // enc.dtype().itemsize
                held.append(ids)
                lengths.append(n)
                keys.append(k.as_py())
                size += n
                if size >= segment_tokens:
                    yield flush()
                    held, lengths, keys, size = [], [], [], 0
                    seg += 1
        if held:
            yield flush()

    schema = f"part int, seg int, tokens long, ids array<{id_type}>, lengths array<long>, codes binary"
    mapped(rows, run, schema, tokens=True).write.option("compression", "none").parquet(path)


def read_codes(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(<id_col>, start, n_tokens, ids_crc32)`` of every document of a dataset:
    ``start`` counts the tokens of all documents before it."""
    segs = spark.read.parquet(path)
    id_type = segs.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for part, seg, ids, lengths, blob in zip(*(b.column(i) for i in range(5)), strict=True):
                codes = DirectCodes(blob.as_py())
                n = np.array(lengths.as_py(), np.int64)
                at = np.cumsum(n) - n
                tokens = codes.slice(0, len(codes)).astype("<u4", copy=False)
                crc = [zlib.crc32(tokens[x : x + y]) for x, y in zip(at, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part.as_py(), np.int32)),
                        pa.array(np.full(len(n), seg.as_py(), np.int32)),
                        ids.values,
                        pa.array(at),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "seg", "id", "at", "n", "crc"],
                )

    docs = mapped(segs.select("part", "seg", "ids", "lengths", "codes"), run, f"part int, seg int, id {id_type}, at long, n long, crc long")
    # Tokens before each segment: a running sum inside each part, and over the parts.
    sizes = segs.select("part", "seg", "tokens")
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("t")).select("part", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("part_start"))
    starts = sizes.withColumn("seg_start", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    return docs.join(starts.drop("tokens"), ["part", "seg"]).select(
        F.col("id").alias(id_col),
        (F.col("part_start") + F.col("seg_start") + F.col("at")).cast("long").alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def token_at(spark: SparkSession, path: str, part: int, seg: int, i: int) -> int:
    """Token i of a segment, read without decoding any other."""
    row = spark.read.parquet(path).where((F.col("part") == part) & (F.col("seg") == seg)).select("codes").first()
    return DirectCodes(bytes(row["codes"])).get(i)
