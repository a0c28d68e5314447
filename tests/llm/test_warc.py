import hashlib
import io

import pytest
import zstandard

from clientcurve.llm import warc_bundles as W
from clientcurve.session import shared_path

PAGES = "page_id long, url string, html string, row long, id string, digest string, n int, payload string, salt int, seq int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 5, "x", "y", 1, "z", 2, 3) for i, u, h in rows], PAGES)


def expected(rows):
    """Record type and target by going through the rows one by one."""
    best = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= W.MIN_REVISIT:
            best[data] = max(best.get(data, (False, 0)), (i is not None, i or 0))
    out, taken = [], set()
    for i, _, h in rows:
        data = (h or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        top = best.get(data)
        first = top == (i is not None, i or 0) and data not in taken
        if top is None or first:
            taken.add(data) if top else None
            out.append((i, len(data), digest, "response", None))
        else:
            out.append((i, len(data), digest, "revisit", top[1] if top[0] else None))
    return out


def case_rows():
    long, other = "é<p>copy</p>" * 120, "q" * 999 + "é"
    rows = [(i, f"http://h{i % 3}/{i}", f"<p>page {i}</p>" * (i % 40 + 1)) for i in range(120)]
    rows += [(1000 + i, "http://hot/x", long) for i in range(150)]  # one payload over half of the rows
    rows += [(2000, "u", "q" * 999), (2001, "u", "q" * 999)]  # a byte too short to be revisited
    rows += [(2002, "u", other), (2003, "u", other)]  # 1,001 bytes of 1,000 characters
    rows += [(2010, None, None), (2011, "a b\r\nX: y\x00%20ü", ""), (2012, "u", None)]
    rows += [(2020, "u", "r" * 2000)] * 3  # equal rows
    rows += [(None, "u", "s" * 1500), (7000, "v", "s" * 1500), (None, "w", "t" * 1500), (None, "w", "t" * 1500)]
    rows += [(2030, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40), (2031, "big", "<b>" + "y" * 900_000)]
    return rows


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_round_trip_and_revisits(spark):
    rows = case_rows()
    path = shared_path(spark, "warc-test")
    W.write_archives(pages(spark, rows).repartition(5), path, bundle_bytes=1 << 17, frame_bytes=1 << 12)
    got = W.read_archives(spark, path)
    assert sort([tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]) == sort(expected(rows))
    back = sort([(r["page_id"], bytes(r["payload"]).decode()) for r in W.restored(spark, path).collect()])
    assert back == sort([(i, h or "") for i, _, h in rows])
    # Revisits name the record that they revisit, and it is a response.
    kinds = {r["record_id"]: r["record_type"] for r in got.collect()}
    assert len(kinds) == len(rows)
    assert all(kinds[r["refers_to_record"]] == "response" for r in got.where("record_type = 'revisit'").collect())


def test_addresses_reach_single_records(spark):
    rows = case_rows()
    path = shared_path(spark, "warc-test")
    W.write_archives(pages(spark, rows), path, bundle_bytes=1 << 17, frame_bytes=1 << 12)
    index = W.record_index(spark, path)
    assert index.count() == len(rows)
    assert index.select("part", "seq").distinct().count() > 1 and index.agg({"frame": "max"}).first()[0] > 3
    for at in index.where("page_id IN (3, 2011, 2031)").collect():
        headers, block = W.fetch(spark, path, at["part"], at["seq"], at["frame"], at["offset"])
        assert headers["WARC-Record-ID"] == at["record_id"]
        assert W.parse_block(block)[1] == ({i: h for i, _, h in rows}[at["page_id"]] or "").encode()
    odd = W.read_archives(spark, path).where("page_id = 2011").first()
    assert odd["url"] == "a%20b%0D%0AX:%20y%00%20ü"
    assert W.read_archives(spark, path).where("page_id = 2010").first()["url"] is None


def test_a_bundle_is_an_ordinary_zstandard_file(spark):
    path = shared_path(spark, "warc-test")
    W.write_archives(pages(spark, case_rows()[:40]).coalesce(1), path, frame_bytes=2000)
    blob = bytes(spark.read.parquet(path).first()["bundle"])
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob), read_across_frames=True).read()
    bundle = W.SeekableBundle(blob)
    assert b"".join(bundle.frame(i) for i in range(len(bundle))) == plain
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and plain.count(b"WARC-Type: response") == 40


def test_frames_are_independent_and_checked():
    w = W.BundleWriter(frame_bytes=500)
    digest = hashlib.sha1(b"").hexdigest()
    for i in range(20):
        body = bytes([65 + i]) * (50 * i)
        w.add(f"r{i}", W.record_bytes("response", f"r{i}", "u", body, len(body), hashlib.sha1(body).hexdigest(), None, "d"))
    blob = w.finish()
    bundle = W.SeekableBundle(blob)
    assert len(bundle) > 5
    for name, frame, offset, length in w.addresses:
        headers, block = bundle.record(frame, offset)
        assert headers["WARC-Record-ID"] == name and len(bundle.frame(frame)) >= offset + length
        assert W.parse_block(block)[1] == bytes([65 + int(name[1:])]) * (50 * int(name[1:]))
    # Damage in one frame is found there and leaves the others readable.
    bad = bytearray(blob)
    bad[len(blob) // 2] ^= 1
    hurt, whole = W.SeekableBundle(bytes(bad)), 0
    for i in range(len(hurt)):
        try:
            whole += hurt.frame(i) == bundle.frame(i)
        except (ValueError, zstandard.ZstdError):
            pass
    assert whole == len(bundle) - 1
    with pytest.raises(ValueError):
        W.SeekableBundle(blob[:-1] + b"\x00")
    empty = W.BundleWriter().finish()
    assert len(W.SeekableBundle(empty)) == 0 and digest


def test_empty_table(spark):
    path = shared_path(spark, "warc-test")
    W.write_archives(pages(spark, []), path)
    assert W.read_archives(spark, path).count() == 0 and W.record_index(spark, path).count() == 0
    assert W.restored(spark, path).count() == 0
