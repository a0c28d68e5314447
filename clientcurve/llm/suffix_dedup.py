"""Suffix-array dedup (operator 6): remove bytes covered by repeated strings.

A byte goes if some string of ``length`` bytes that covers it also starts
anywhere else, in its own document or another. Strings are judged on the input;
matches never cross documents.

All suffixes of the corpus are not sorted against each other. Equal strings
have equal content, hence the same *anchor*: the smallest (hash, then leftmost)
of the ``gram``-byte substrings inside them. So

1. each document's string starts fall into *runs*, maximal ranges of starts with
   one anchor (a text of over a MiB is read in overlapping stretches, and a run
   may end with its stretch). A run is keyed by its anchor's hash and by the hash of its whole
   span (first start to last start + length). Equal runs of a slice of texts are one
   row: copies and common passages collapse before anything is shuffled;
2. runs whose anchor occurs once are unique; runs whose whole span occurs again
   are repeated throughout. Only runs with a repeated anchor and a span of its
   own, at the edges of repeated passages, need their text;
3. for these, one copy of each distinct span of the anchor comes together. In
   the task the suffixes at all starts are sorted by merging sorted halves;
   two suffixes are compared through prefix polynomial hashes: binary search
   finds their common extension and the next byte decides. Neighbours with a
   common extension of ``length`` bytes are repeats. Every such claim is
   verified on the bytes; a claim that fails (a collision) has its task's
   strings compared exactly instead. Claims of step 2 (equal 64-bit
   anchor and span hashes) and of step 4 (two 64-bit hashes) rest on these 128
   bits alone, not on the bytes;
4. an anchor with more than ``max_spans`` distinct spans (the edge of a passage
   in a large part of all documents) is not sorted in one task: its spans are
   dealt to many tasks, each settles the strings that repeat among its own, and
   one copy of each of its strings, as two independent polynomial hashes, goes to
   a bucket of its hash, where strings from all tasks meet. A string in any share
   of the documents costs a bucket one entry a task. No occurrence is left out;
5. the ranges of repeated starts of a text are merged, and the text is cut.

Work on texts is keyed by a 128-bit hash, so a group of identical documents is
one text for all but the first pass and the final join.

Defined cases: null is the empty text; texts shorter than ``length`` lose
nothing; repeated rows repeat each other's strings; ids are only carried along,
null or not; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, join_hot, mapped, sorted_groups, stored, text_slices
from ._hashing import BASES, PrefixHash, mix

SLICE_BYTES = 1 << 20
GRAM = 32
MAX_SPANS = 1024
PLACE_BITS = 24


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, in two passes over blocks of w."""
    n = len(v)
    pad = -n % w
    full = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of a slice: (document, first start, number of starts, anchor's offset
    from the first start, anchor hash, span hash), starts counted in the
    document."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length:
        return empty
    first = PrefixHash(data)
    grams = first.grams(gram)
    hashes = mix(grams)
    place = np.arange(len(hashes), dtype=np.uint64)
    # Stretches are no longer than this; the bits depend on nothing else, so that equal strings have one anchor everywhere.
    bits = max(PLACE_BITS, (SLICE_BYTES + length).bit_length())
    packed = (hashes >> np.uint64(bits)) << np.uint64(bits) | place
    best = _window_min(packed, length - gram + 1)  # of each start of a string
    starts_in = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(starts_in.sum())
    if not total:
        return empty
    doc = np.repeat(np.arange(len(starts_in)), starts_in)
    at = np.arange(total) - np.repeat(np.cumsum(starts_in) - starts_in, starts_in)
    glob = at + offsets[doc]
    anchor = (best[glob] & np.uint64((1 << bits) - 1)).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, total))
    begin = glob[heads]
    lead = anchor[heads] - begin
    end = begin + count - 1 + length
    second = PrefixHash(data, BASES[1])
    span = mix(first.at(begin, end) + np.uint64(0x632BE59BD9B4E019) * lead.astype(np.uint64))
    span = mix(span ^ second.at(begin, end) ^ (count.astype(np.uint64) << np.uint64(32)))
    return doc[heads], at[heads], count, lead, hashes[anchor[heads]], span


def text_key(text: np.ndarray) -> bytes:
    return hashlib.md5(text.tobytes(), usedforsecurity=False).digest()


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, size: int):
    """(bytes, offsets, first byte) of a slice's stretches: the slice itself, or
    pieces of a text that is longer than ``size``. Pieces overlap by
    ``length - 1`` bytes, so every string starts in exactly one."""
    if len(data) <= size:
        yield data, offsets, 0
        return
    for lo in range(0, max(len(data) - length + 1, 0), size):
        part = data[lo : lo + size + length - 1]
        yield part, np.array([0, len(part)]), lo


PLACE = np.dtype([("key", "V16"), ("at", "<i4")])
RUNS = "anchor long, span long, starts int, lead int, m long, key binary, at int, places binary"


def _runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs, equal ones of a slice of texts as one row: how many (``m``), one place
    (``key``, ``at``) and, where there are several, all of them. A passage that many
    texts share is combined before anything is shuffled."""

    def run(batches):
        for batch in batches:
            for lo, size, whole, offsets in text_slices(batch, "text", SLICE_BYTES):
                keys = np.frombuffer(b"".join(batch.column(0).slice(lo, size).to_pylist()), "V16")
                times = batch.column(2).slice(lo, size).to_numpy()
                for data, off, shift in stretches(whole, offsets, length, SLICE_BYTES):
                    doc, at, count, lead, anchor, span = anchor_runs(data, off, length, gram)
                    if len(doc):
                        yield _grouped(keys[doc], at + shift, count, lead, anchor.view(np.int64), span.view(np.int64), times[doc])

    return mapped(texts.select("key", "text", "m"), run, RUNS)


def _grouped(key, at, count, lead, anchor, span, times) -> pa.RecordBatch:
    order = np.lexsort((span, anchor))
    x, y = anchor[order], span[order]
    heads = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    sizes = np.diff(np.append(heads, len(order)))
    first = order[heads]
    all_places = np.empty(len(order), PLACE)
    all_places["key"], all_places["at"] = key[order], at[order]
    raw = all_places.tobytes()
    places = [raw[PLACE.itemsize * h : PLACE.itemsize * (h + n)] if n > 1 else None for h, n in zip(heads.tolist(), sizes.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor[first]),
            pa.array(span[first]),
            pa.array(count[first].astype(np.int32)),
            pa.array(lead[first].astype(np.int32)),
            pa.array(np.add.reduceat(times[order], heads)),
            pa.array([k.tobytes() for k in key[first]], pa.binary()),
            pa.array(at[first].astype(np.int32)),
            pa.array(places, pa.binary()),
        ],
        names=["anchor", "span", "starts", "lead", "m", "key", "at", "places"],
    )


def _all_places(rows: DataFrame) -> DataFrame:
    """``(key, ranges)`` of the places of runs: a task sends one row a text, and texts
    that are copies send the same row."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            starts, keys, at, packed = (batch.column(i) for i in range(4))
            for n, k, a, many in zip(starts.to_pylist(), keys.to_pylist(), at.to_pylist(), packed.to_pylist(), strict=True):
                own = np.frombuffer(many, PLACE) if many is not None else np.array([(k, a)], PLACE)
                held.append((own, n))
                size += len(own)
            if size > 1 << 18:
                yield from _by_text(held)
                held, size = [], 0
        yield from _by_text(held)

    ranges = mapped(rows.select("starts", "key", "at", "places"), run, f"key binary, {_RANGES_OF_TEXT}")
    return ranges.distinct()


_RANGES_OF_TEXT = "ranges array<struct<at:int,starts:int>>"


def _by_text(held: list[tuple[np.ndarray, int]]):
    if not held:
        return
    places = np.concatenate([p for p, _ in held])
    starts = np.repeat([n for _, n in held], [len(p) for p, _ in held]).astype(np.int32)
    halves = np.ascontiguousarray(places["key"]).view("<u8").reshape(-1, 2)
    order = np.lexsort((places["at"], halves[:, 1], halves[:, 0]))
    halves, at, starts, keys = halves[order], places["at"][order], starts[order], places["key"][order]
    other = np.r_[True, (halves[1:] != halves[:-1]).any(axis=1)]
    once = other | np.r_[True, at[1:] != at[:-1]]
    other, at, starts, keys = other[once], at[once], starts[once], keys[once]
    heads = np.flatnonzero(other)
    offsets = np.append(heads, len(at)).astype(np.int32)
    for lo in range(0, len(heads), 1 << 14):
        hi = min(lo + (1 << 14), len(heads))
        part = slice(offsets[lo], offsets[hi])
        flat = pa.StructArray.from_arrays([pa.array(at[part].astype(np.int32)), pa.array(starts[part])], names=["at", "starts"])
        lists = pa.ListArray.from_arrays(pa.array(offsets[lo : hi + 1] - offsets[lo]), flat)
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys[heads[lo:hi]]], pa.binary()), lists], names=["key", "ranges"])


class SuffixSorter:
    """Sorts suffixes of one byte array by their first ``limit`` bytes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit, self.hash = data, limit, PrefixHash(data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of suffix pairs, up to the limit: binary search over
        prefix lengths, from the whole length down, each step one comparison of
        hashes."""
        out = np.full(len(a), self.limit, np.int64)
        rest = np.flatnonzero(self.hash.at(a, a + self.limit) != self.hash.at(b, b + self.limit))
        a, b = a[rest], b[rest]
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), self.limit - 1, np.int64)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hash.at(a, a + mid) == self.hash.at(b, b + mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        out[rest] = low
        return out

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        lcp = self.extension(a, b)
        equal = lcp >= self.limit
        step = np.minimum(lcp, self.limit - 1)
        return np.where(equal, or_equal, self.data[a + step] < self.data[b + step])

    def sort(self, suffix: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Merge sort inside each segment (segments must be contiguous), all
        segments at once: in a merge, an element's place is its rank in its own
        half plus its rank in the other half, found by binary search."""
        suffix = suffix.copy()
        n = len(suffix)
        head = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        size = np.diff(np.append(head, n))
        base = np.repeat(head, size)
        place = np.arange(n) - base
        size = np.repeat(size, size)
        width, most = 1, int(size.max(initial=0))
        while width < most:
            pair = place // (2 * width) * (2 * width)
            right = place - pair >= width
            other = np.where(right, pair, pair + width)
            low = np.minimum(other, size)
            high = np.minimum(other + width, size)
            start = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                probe = suffix[base[open_] + mid]
                mine = suffix[open_]
                # ties keep the left half first
                goes = np.where(right[open_], self.less(probe, mine, True), self.less(probe, mine, False))
                low[open_] = np.where(goes, mid + 1, low[open_])
                high[open_] = np.where(goes, high[open_], mid)
            rank = low - start
            own = np.where(right, place - pair - width, place - pair)
            out = np.empty_like(suffix)
            out[base + pair + own + rank] = suffix
            suffix = out
            width *= 2
        return suffix


def repeated_starts(spans: list[np.ndarray], starts: np.ndarray, group: np.ndarray, lead: np.ndarray, length: int) -> list[np.ndarray]:
    """For each span, which of its strings occur again among the strings of the
    spans of its group. ``starts``: strings of a span; ``lead``: place of the
    anchor in the first string. Strings with different places of the anchor
    differ, so suffixes are sorted inside (group, place) segments."""
    data = np.concatenate(spans)
    at = np.concatenate([[0], np.cumsum([len(s) for s in spans])[:-1]])
    owner = np.repeat(np.arange(len(spans)), starts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    suffix = at[owner] + inner
    place = lead[owner] - inner
    order = np.lexsort((suffix, place, group[owner]))
    seg_new = np.ones(len(order), bool)
    g, p = group[owner][order], place[order]
    seg_new[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1])
    segment = np.cumsum(seg_new) - 1
    several = np.bincount(segment)[segment] > 1
    again = np.zeros(len(data), bool)
    if several.any():
        suf, seg = suffix[order][several], segment[several]
        sorter = SuffixSorter(data, length)
        suf, seg = _with_equal_heads(sorter.hash, suf, seg, length // 2)
        suf = sorter.sort(suf, seg)
        a, b = suf[:-1], suf[1:]
        near = seg[1:] == seg[:-1]
        a, b = a[near], b[near]
        same = sorter.extension(a, b) >= length
        a, b = a[same], b[same]
        if _verified(data, a, b, length):
            again[a] = again[b] = True
        else:  # a collision of hashes: compare the strings themselves
            seen: dict[bytes, int] = {}
            for s, k in zip(suf, seg, strict=True):
                t = int(k).to_bytes(8, "little") + data[s : s + length].tobytes()
                if t in seen:
                    again[s] = again[seen[t]] = True
                seen[t] = s
    return [again[x : x + n] for x, n in zip(at, starts, strict=True)]


def _with_equal_heads(hashes: PrefixHash, suffix: np.ndarray, segment: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first ``head`` bytes begin another suffix of their segment,
    and their segments cut by these bytes' hash. Only they can be repeats, and only
    among themselves; near the edges of a passage most suffixes go here."""
    h = hashes.at(suffix, suffix + head)
    order = np.lexsort((suffix, h, segment))
    suffix, segment, h = suffix[order], segment[order], h[order]
    new = np.r_[True, (segment[1:] != segment[:-1]) | (h[1:] != h[:-1])]
    part = np.cumsum(new) - 1
    stays = np.bincount(part)[part] > 1
    return suffix[stays], part[stays]


def _verified(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> bool:
    """Whether data[a:a+length] == data[b:b+length] for all pairs; pairs that
    step on together are checked as one stretch."""
    if not len(a):
        return True
    order = np.lexsort((a, b - a))
    a, shift = a[order], (b - a)[order]
    cut = np.flatnonzero(np.r_[True, (np.diff(a) > length) | (np.diff(shift) != 0)])
    last = np.append(cut[1:], len(a)) - 1
    return all(np.array_equal(data[x:y], data[x + s : y + s]) for x, y, s in zip(a[cut], a[last] + length, shift[cut], strict=True))


def _ranges(flags: np.ndarray, at: int) -> list[tuple[int, int]]:
    """Maximal ranges (first, count) of true flags, shifted by ``at``."""
    d = np.diff(np.r_[0, flags.astype(np.int8), 0])
    a, b = np.flatnonzero(d == 1), np.flatnonzero(d == -1)
    return [(int(x) + at, int(y - x)) for x, y in zip(a, b, strict=True)]


RANGES = "key binary, at int, starts int"


def _range_batch(keys, ranges) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([r[0] for r in ranges], pa.int32()), pa.array([r[1] for r in ranges], pa.int32())], names=["key", "at", "starts"])


def _sorted_blocks(spans: DataFrame, length: int) -> DataFrame:
    """Repeated ranges by suffix sort; several anchors share one sort."""

    def flush(groups):
        rows = [r for g in groups for r in g]
        group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        texts = [np.frombuffer(r["bytes"], np.uint8) for r in rows]
        flags = repeated_starts(texts, np.array([r["starts"] for r in rows]), group, np.array([r["lead"] for r in rows]), length)
        keys, found = [], []
        for r, f in zip(rows, flags, strict=True):
            if not r["whole"]:
                got = _ranges(f, r["at"])
                found += got
                keys += [r["key"]] * len(got)
        return _range_batch(keys, found)

    def run(batches):
        held, size = [], 0
        for g in sorted_groups(batches, ["anchor"]):
            rows = g.to_pylist()
            held.append(rows)
            size += sum(len(r["bytes"]) for r in rows)
            if size > SLICE_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return mapped(spans, run, RANGES)


ENTRY = np.dtype([("one", "<u8"), ("two", "<u8"), ("span", "<i4"), ("at", "<i4")])
MEETING_SPANS, BUCKET_STRINGS = 512, 1 << 17


def _met(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each distinct pair in sorted order, size of its class, for each
    element): positions of one representative, and how often each occurs."""
    order = np.lexsort((two, one))
    x, y = one[order], two[order]
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
    heads = np.flatnonzero(new)
    count = np.empty(len(one), np.int64)
    count[order] = np.repeat(np.diff(np.append(heads, len(one))), np.diff(np.append(heads, len(one))))
    return order[heads], count


def _counted(spans: DataFrame, length: int, parts: int, scratch: Scratch) -> DataFrame:
    """Repeated ranges of anchors with very many spans (step 4 above)."""
    total = spans.agg(F.sum("starts")).first()[0] or 0
    buckets = 1 + total // BUCKET_STRINGS

    def settle(batches):
        for b in batches:
            for lo in range(0, b.num_rows, MEETING_SPANS):
                part = b.slice(lo, MEETING_SPANS)
                n = part.column(2).to_numpy().astype(np.int64)
                keys, first, whole = part.column(0).to_pylist(), part.column(1).to_numpy(), part.column(3).to_numpy(zero_copy_only=False)
                for _, _, data, off in text_slices(part, "bytes", 1 << 30):
                    owner = np.repeat(np.arange(len(n)), n)
                    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                    x = off[owner] + inner
                    one, two = (mix(PrefixHash(data, base).at(x, x + length)) for base in BASES)
                reps, count = _met(one, two)
                again = (count > 1) & ~whole[owner]
                out_keys, ranges = [], []
                for i in np.unique(owner[again]):
                    got = _ranges(again[np.searchsorted(owner, i) : np.searchsorted(owner, i, side="right")], int(first[i]))
                    ranges += got
                    out_keys += [keys[i]] * len(got)
                k = len(out_keys)
                if k:
                    yield _meeting(out_keys, [r[0] for r in ranges], [r[1] for r in ranges], [None] * k, [None] * k, [None] * k)
                entries = np.empty(len(reps), ENTRY)
                entries["one"], entries["two"] = one[reps], two[reps]
                # Strings that are settled here are sent without a span: only as partners of others.
                entries["span"] = np.where((count[reps] > 1) | whole[owner[reps]], -1, owner[reps])
                entries["at"] = first[owner[reps]] + inner[reps]
                bucket = (entries["one"] >> np.uint64(11)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                entries, bucket = entries[order], bucket[order]
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                packed = b"".join(keys)
                m = len(cuts)
                if m:
                    yield _meeting([None] * m, [None] * m, [None] * m, bucket[cuts].astype(np.int64).tolist(), [p.tobytes() for p in np.split(entries, cuts[1:])], [packed] * m)

    def _meeting(keys, at, starts, bucket, entries, spans_):
        types = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((keys, at, starts, bucket, entries, spans_), types, strict=True)], names=["key", "at", "starts", "bucket", "entries", "keys"])

    dealt = spans.select("key", "at", "starts", "whole", "bytes", "anchor").repartitionByRange(parts, "anchor", "key").sortWithinPartitions("anchor", "key")
    table = stored(mapped(dealt, settle, "key binary, at int, starts int, bucket long, entries binary, keys binary"), "dedup-meeting", scratch=scratch)

    def meet(batches):
        for g in sorted_groups(batches, ["bucket"]):
            parts_ = [np.frombuffer(e, ENTRY) for e in g.column("entries").to_pylist()]
            all_keys = g.column("keys").to_pylist()
            e = np.concatenate(parts_)
            row = np.repeat(np.arange(len(parts_)), [len(p) for p in parts_])
            _, count = _met(e["one"], e["two"])
            hit = np.flatnonzero((count > 1) & (e["span"] >= 0))
            if len(hit):
                yield _range_batch([all_keys[r][16 * s : 16 * s + 16] for r, s in zip(row[hit], e["span"][hit], strict=True)], [(int(a), 1) for a in e["at"][hit]])

    meeting = table.where("bucket IS NOT NULL").select("bucket", "entries", "keys").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return table.where("key IS NOT NULL").select("key", "at", "starts").union(mapped(meeting, meet, RANGES))


def _merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [first, end) with those that overlap or touch made one."""
    order = np.argsort(first, kind="stable")
    first, end = first[order].astype(np.int64), np.maximum.accumulate(end[order].astype(np.int64))
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > end[:-1]
    heads = np.flatnonzero(new)
    return first[heads], end[np.append(heads[1:], len(first)) - 1]


def _cut(found: DataFrame, length: int, with_text: bool, keep: int | None) -> DataFrame:
    """Rows (key, ranges, text, m) -> per text: removed bytes, spans, hash and (on
    demand) what is left; the text itself where a run of ``keep`` bytes is removed."""

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                keys, ranges = b.column(0), b.column(1)
                flat, ends = ranges.flatten(), np.cumsum(np.diff(ranges.offsets.to_numpy()))
                at, starts = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "starts"))
                removed, spans, sha, left, kept = [], [], [], [], []
                for i, text in enumerate(b.column(2)):
                    raw = text.as_py() or b""
                    x, n = (v[ends[i - 1] if i else 0 : ends[i]] for v in (at, starts))
                    a, z = _merged(x, x + n - 1 + length)
                    bounds = np.concatenate([[0], np.stack([a, z], 1).ravel(), [len(raw)]]).tolist()
                    rest = b"".join(raw[bounds[j] : bounds[j + 1]] for j in range(0, len(bounds), 2))
                    removed.append(int((z - a).sum()))
                    spans.append(len(a))
                    sha.append(hashlib.sha256(rest).hexdigest())
                    left.append(rest.decode("utf-8", "ignore") if with_text else None)
                    kept.append(raw if keep is not None and len(a) and (z - a).max() >= keep else None)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(left, pa.string()), pa.array(kept, pa.binary()), b.column(3)],
                    names=["key", "removed", "spans", "sha", "left", "text", "m"],
                )

    return mapped(found, run, "key binary, removed long, spans long, sha string, left string, text binary, m long")


def _texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """``(key, text, m)`` of the texts that can lose bytes."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(key_of(F.col(text_col)).alias("key"), text.alias("text"), F.lit(1).cast("long").alias("m")).where(F.octet_length("text") >= length)


def repeated_cuts(docs: DataFrame, text_col: str = "text", length: int = 400, gram: int = GRAM, max_spans: int = MAX_SPANS, with_text: bool = False) -> DataFrame:
    """``(key, removed, spans, sha, left)`` of each distinct text that loses
    bytes; ``key`` is :func:`key_of` the text, ``left`` what stays, on demand, as text (a character cut in two goes)."""
    return _cuts(_texts(docs, text_col, length), length, gram, max_spans, with_text).select("key", "removed", "spans", "sha", "left")


def _cuts(texts: DataFrame, length: int, gram: int, max_spans: int, with_text: bool = False, keep: int | None = None) -> DataFrame:
    """``(key, removed, spans, sha, left, text, m)`` of each distinct text of
    ``texts(key, text, m)``, a row standing for ``m`` documents, that loses bytes."""
    spark = texts.sparkSession
    scratch = Scratch(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = stored(_runs(texts, length, gram), "dedup-runs", scratch=scratch)

    # Anchors that occur more than once, then the runs of these alone.
    often = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("m").alias("all")).where("all > 1").drop("all")
    live = stored(join_hot(runs, often, ["anchor"], "n", parts, scratch).drop("n"), "dedup-live", scratch=scratch)
    rep = F.min(F.struct("key", "at", "starts", "lead")).alias("rep")
    kinds = stored(live.groupBy("anchor", "span").agg(F.sum("m").alias("m"), rep, F.count("*").alias("n")), "dedup-spans", scratch=scratch)
    whole = _all_places(join_hot(live.drop("m"), kinds.where("m > 1").select("anchor", "span", "n"), ["anchor", "span"], "n", parts, scratch))

    # Spans to compare: one of each kind, where some kind of the anchor stands alone.
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("m").alias("least")).where("kinds > 1 AND least = 1")
    wanted = join_hot(kinds.drop("n"), mixed, ["anchor"], "kinds", parts, scratch).select("rep.*", "anchor", (F.col("m") > 1).alias("whole"), (F.col("kinds") > max_spans).alias("hot"))
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "starts", "lead", "anchor", "whole", "hot")).alias("spans"))
    one = texts.groupBy("key").agg(F.first("text").alias("text"), F.sum("m").alias("m"))
    cut_out = one.join(by_text, "key")
    spans = cut_out.select("key", "text", F.inline("spans")).select(
        "key", "at", "starts", "lead", "anchor", "whole", "hot", F.col("text").substr(F.col("at") + 1, F.col("starts") + (length - 1)).alias("bytes")
    )
    spans = stored(spans, "dedup-context", scratch=scratch)
    few = spans.where("NOT hot").repartition(parts, "anchor").sortWithinPartitions("anchor")
    found = _sorted_blocks(few, length).union(_counted(spans.where("hot"), length, parts, scratch))
    found = whole.unionByName(found.groupBy("key").agg(F.collect_list(F.struct("at", "starts")).alias("ranges")))

    ranges = found.groupBy("key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    ranges = stored(ranges, "dedup-ranges", scratch=scratch)
    cut = stored(_cut(one.join(ranges, "key").select("key", "ranges", "text", "m"), length, with_text, keep), "dedup-cut")
    scratch.remove()
    return cut


def key_of(text: Column) -> Column:
    """128 bits that stand for a text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = GRAM, max_spans: int = MAX_SPANS, passage: int | None = None
) -> DataFrame:
    """``(<id_col>, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of
    ``docs``. With ``passage``, a smaller length, also ``n_passage_bytes``: bytes
    covered by repeated strings of that length. These are found first; a repeated
    string of ``length`` bytes lies in a run of that many such bytes, in both its
    places, so only texts with such a run are searched again."""
    if passage is not None and not gram <= passage < length:
        raise ValueError("a passage is shorter than the strings that are removed, and has an anchor")
    if passage is None:
        cut = repeated_cuts(docs, text_col, length, gram, max_spans).drop("left")
    else:
        near = _cuts(_texts(docs, text_col, passage), passage, gram, max_spans, keep=length)
        far = _cuts(near.where("text IS NOT NULL").select("key", "text", "m"), length, gram, max_spans)
        near = near.select("key", F.col("removed").alias("passages"))
        cut = near.join(far.select("key", "removed", "spans", "sha"), "key", "left")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col), key_of(F.col(text_col)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha_all"))
    out = rows.join(cut, "key", "left")
    more = [] if passage is None else [F.coalesce("passages", F.lit(0)).cast("long").alias("n_passage_bytes")]
    return out.select(
        id_col,
        "n_bytes",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "sha_all").alias("kept_sha256"),
        *more,
    )


def without_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; all rows and other
    columns stay. A character cut in two goes."""
    cut = repeated_cuts(docs, text_col, with_text=True, **options).select(F.col("key").alias("__key"), F.col("left").alias("__left"))
    joined = docs.join(cut, key_of(F.col(text_col)) == F.col("__key"), "left")
    kept = F.when(F.col("__key").isNull(), F.col(text_col)).otherwise(F.col("__left"))
    return joined.select(*[kept.alias(c) if c == text_col else docs[f"`{c}`"] for c in docs.columns])
