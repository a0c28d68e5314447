"""WARC archives (operator 11): seekable Zstandard bundles.

A bundle is a WARC file, compressed as independent Zstandard frames of about
``frame_bytes`` of whole records, and ended by a seek table in a skippable frame:

    skippable frame   u32 0x184D2A5E  u32 size
    for each frame    u32 compressed bytes  u32 bytes  u32 checksum (low half of XXH64)
    footer            u32 frames  u8 0x80 (checksums)  u32 0x8F92EAB1

so any Zstandard reader unpacks the whole file, and a reader of the table unpacks
one frame alone. A record's address is (bundle, frame, offset in the unpacked
frame, length); a dataset keeps the addresses of a bundle's records beside it.

A dataset is a Parquet table with a row a bundle: Spark writes and commits it, so a
lost executor leaves no half file, and it can lie wherever Spark can write.

    part, seq                               number of the bundle
    record_ids, frames, offsets, lengths    addresses of its records
    bundle                                  the file's bytes

Of records with equal payloads of at least ``min_revisit`` bytes, that of the largest
id is a ``response``; the others are ``revisit`` records, which carry its digest,
its record id and their own HTTP headers, but no payload. Equal payloads are found
by SHA-1 and length, on rows of a few numbers: copies are counted before the
shuffle, and rows meet their digest's response over ``SALTS`` salts, so that a
payload which a third of all rows share is no one task's work. The payloads
themselves are shuffled once, by row number.

Reading unpacks frame by frame, and checks the checksum of each frame and the
digest of each payload.

Defined cases: a null text is an empty payload; a null url gives a record without
target, and control characters of a url are percent-encoded; null ids are smaller
than all others; of rows that repeat id and payload, one is the response and the
others revisit it; an empty table gives an empty dataset; other columns are not
read. A record is never cut: one longer than ``frame_bytes`` is a frame of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, mapped, stored

# Fixed values of the seekable format and of the archive format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT = 1000
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 22  # before compression
SALTS = 16
WRITE_DATE = "1970-01-01T00:00:00Z"  # pages carry no date; reruns agree
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_RECORD_ID = re.compile(r"<urn:page:(null|-?\d+):(\d+)>")


# ------------------------------------------------------------------ records
def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{row}>"


def page_of(record: str) -> int | None:
    """The page id inside a record id."""
    page = _RECORD_ID.fullmatch(record).group(1)
    return None if page == "null" else int(page)


def record_bytes(kind: str, name: str, url: str | None, payload: bytes, payload_bytes: int, sha1_hex: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP headers of its response, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda c: f"%{ord(c.group()):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, place of the next record) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record at this place")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its block")
    return headers, data[start:stop], stop + 4


def parse_block(block: bytes) -> tuple[int, bytes]:
    """(payload length as its HTTP header has it, payload) of a record's block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return int(fields["Content-Length"]), payload


# ------------------------------------------------------------------ bundles
class BundleWriter:
    """Groups records into frames, and closes the file with its seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self._frame_bytes = frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._out, self._table, self._held = [], [], bytearray()
        self.size = 0  # bytes of records so far
        self.addresses: list[tuple[str, int, int, int]] = []  # record id, frame, offset, length

    def add(self, name: str | None, record: bytes) -> None:
        if self._held and len(self._held) + len(record) > self._frame_bytes:
            self._close_frame()
        if name is not None:
            self.addresses.append((name, len(self._table), len(self._held), len(record)))
        self._held += record
        self.size += len(record)

    def _close_frame(self) -> None:
        data = bytes(self._held)
        packed = self._zstd.compress(data)
        self._out.append(packed)
        self._table.append(struct.pack("<III", len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self._held.clear()

    def finish(self) -> bytes:
        if self._held:
            self._close_frame()
        table = b"".join(self._table) + struct.pack("<IBI", len(self._table), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        return b"".join(self._out) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


class SeekableBundle:
    """Reader of one bundle: any frame, and any record, without the others."""

    def __init__(self, blob: bytes):
        self._blob = memoryview(blob)
        frames, flags, magic = struct.unpack_from("<IBI", blob, len(blob) - 9)
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("not a bundle with a seek table")
        start = len(blob) - 9 - 12 * frames
        if struct.unpack_from("<II", blob, start - 8) != (SKIPPABLE_MAGIC, 12 * frames + 9):
            raise ValueError("the seek table does not fit its frame")
        self._table = np.frombuffer(blob, "<u4", 3 * frames, start).reshape(frames, 3).astype(np.int64)
        self._ends = np.cumsum(self._table[:, 0])
        if (self._ends[-1] if frames else 0) != start - 8:
            raise ValueError("the seek table does not cover the frames")
        self._zstd = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        """Number of frames."""
        return len(self._table)

    def frame(self, i: int) -> bytes:
        size, full, checksum = self._table[i].tolist()
        end = int(self._ends[i])
        data = self._zstd.decompress(self._blob[end - size : end], max_output_size=full)
        if len(data) != full or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return data

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        """(headers, block) of the record at a place of a frame."""
        return parse_record(self.frame(frame), offset)[:2]

    def records(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        """(frame, offset, headers, block) of all records, a frame at a time."""
        for i in range(len(self)):
            data, at = self.frame(i), 0
            while at < len(data):
                headers, block, after = parse_record(data, at)
                yield i, at, headers, block
                at = after


# ------------------------------------------------------------------ dataset
def _revisits(rows: DataFrame, min_revisit: int) -> DataFrame:
    """``(row, to_id, to_row)``: the rows that revisit, and their response."""
    long = rows.select("row", "id", "digest", "n").where(F.col("n") >= min_revisit)
    top = long.groupBy("digest", "n").agg(F.count("*").alias("copies"), F.max(F.struct("id", (-F.col("row")).alias("back"))).alias("top"))
    top = top.where("copies > 1").select("digest", "n", F.col("top.id").alias("to_id"), (-F.col("top.back")).alias("to_row"))
    top = top.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    long = long.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    return long.join(top, ["digest", "n", "salt"]).where("row <> to_row").select("row", "to_id", "to_row")


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit: int = MIN_REVISIT,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = WRITE_DATE,
) -> None:
    """Write a record for every row of ``pages`` to the dataset at ``path`` (which
    must be new)."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    scratch = Scratch(pages.sparkSession)
    rows = stored(
        pages.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
            F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n"), payload.alias("payload"),
        ),
        "warc-rows",
        compression="zstd",
        scratch=scratch,
    )
    told = rows.join(_revisits(rows, min_revisit), "row", "left")
    told = told.select("row", "id", "url", "digest", "n", F.when(F.col("to_row").isNull(), F.col("payload")).alias("payload"), "to_id", "to_row")

    def run(batches):
        from pyspark import TaskContext

        part, seq, made = TaskContext.get().partitionId(), 0, None

        def begun() -> BundleWriter:
            new = BundleWriter(frame_bytes)
            info = f"software: clientcurve\r\nformat: WARC File Format 1.1\r\nbundle: {part}-{seq}\r\n".encode()
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:bundle:{part}:{seq}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
            new.add(None, head.encode() + info + b"\r\n\r\n")
            return new

        def flush(done: BundleWriter):
            names, frames, offsets, lengths = zip(*done.addresses, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([names], pa.list_(pa.string())),
                    pa.array([frames], pa.list_(pa.int32())),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([done.finish()], pa.binary()),
                ],
                names=["part", "seq", "record_ids", "frames", "offsets", "lengths", "bundle"],
            )

        for batch in batches:
            for row, page, url, digest, n, body, to_page, to_row in zip(*(c for c in batch.columns), strict=True):
                made = made or begun()
                name = record_id(page.as_py(), row.as_py())
                to = record_id(to_page.as_py(), to_row.as_py()) if to_row.is_valid else None
                made.add(name, record_bytes("revisit" if to else "response", name, url.as_py(), body.as_py() or b"", n.as_py(), digest.as_py(), to, date))
                if made.size >= bundle_bytes:
                    yield flush(made)
                    made, seq = None, seq + 1
        if made:
            yield flush(made)

    schema = "part int, seq int, record_ids array<string>, frames array<int>, offsets array<long>, lengths array<long>, bundle binary"
    # The bundles are compressed already; small row groups keep a reader's batches small.
    mapped(told, run, schema).write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path)
    scratch.remove()


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, page_id, part, seq, frame, offset, length)``: the address of
    every record; the bundles themselves are not read."""
    at = F.explode(F.arrays_zip("record_ids", "frames", "offsets", "lengths")).alias("at")
    rows = spark.read.parquet(path).select("part", "seq", at)
    page = F.regexp_extract("at.record_ids", r":(-?\d+):\d+>$", 1).try_cast("long")
    return rows.select(
        F.col("at.record_ids").alias("record_id"), page.alias("page_id"), "part", "seq",
        F.col("at.frames").alias("frame"), F.col("at.offsets").alias("offset"), F.col("at.lengths").alias("length"),
    )


def fetch(spark: SparkSession, path: str, part: int, seq: int, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record at an address; one frame is unpacked."""
    row = spark.read.parquet(path).where((F.col("part") == part) & (F.col("seq") == seq)).select("bundle").first()
    return SeekableBundle(bytes(row["bundle"])).record(frame, offset)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    record_id, refers_to_record, payload)`` of every record of a dataset, from its
    bundles alone. Damaged frames and payloads that miss their digest raise."""

    def run(batches):
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "refers_to_record", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for blob in batch.column(0):
                out, held = [], 0
                for _, _, headers, block in SeekableBundle(blob.as_py()).records():
                    kind, name, to = headers["WARC-Type"], headers["WARC-Record-ID"], headers.get("WARC-Refers-To")
                    if kind not in ("response", "revisit"):
                        continue
                    size, payload = parse_block(block)
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"the payload of {name} does not have its digest")
                    kept = payload if with_payload and kind == "response" else None
                    out.append((page_of(name), headers.get("WARC-Target-URI"), size, digest, kind, page_of(to) if to else None, name, to, kept))
                    held += len(kept or b"")
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_record string, payload binary"
    return mapped(spark.read.parquet(path).select("bundle"), run, schema)


def restored(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, url, payload)`` of every record; a revisit has its response's."""
    records = read_archives(spark, path, with_payload=True)
    own = records.where("record_type = 'response'").select("page_id", "url", "payload")
    again = records.where("record_type = 'revisit'").select("page_id", "url", "refers_to_record", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int").alias("salt"))
    asked = again.select("refers_to_record", "salt").distinct()
    to = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), "payload")
    to = asked.join(to, "refers_to_record")  # a payload once a salt that asks for it
    return own.unionByName(again.join(to, ["refers_to_record", "salt"]).select("page_id", "url", "payload"))
