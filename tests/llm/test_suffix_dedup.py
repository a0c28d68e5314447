import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from clientcurve.llm import suffix_dedup as S


def brute(texts, length):
    """[(bytes, removed, spans, hash of the rest, rest)] of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        rest = bytes(b for b, g in zip(t, gone[:-1], strict=True) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def corpus(seed, length):
    rnd = random.Random(seed)
    shared = "".join(rnd.choice("abcd é") for _ in range(3 * length))
    rows = []
    for i in range(50):
        a = rnd.randrange(length)
        own = ["".join(rnd.choice("wxyz ") for _ in range(rnd.randrange(length))) for _ in range(2)]
        rows.append((i, own[0] + shared[a : a + rnd.randrange(length // 2, 2 * length)] + own[1]))
    rows += [(60, None), (61, ""), (62, "ab" * length), (63, "q" * (length - 1)), (64, "r" * length), (65, "s" * (length + 1)), (None, shared), (64, "t" * length), (66, shared), (66, shared)]
    return rows


@pytest.mark.parametrize("max_spans", [1024, 2])
@pytest.mark.parametrize("length", [40, 120])
def test_equals_brute_force(make_docs, length, max_spans):
    rows = corpus(length, length)
    out = S.suffix_dedup(make_docs(rows), length=length, gram=16, max_spans=max_spans)
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter((r[0], *b[:4]) for r, b in zip(rows, brute([r[1] for r in rows], length), strict=True))


def test_texts_without_repeats(make_docs):
    rows = corpus(5, 60)
    docs = make_docs(rows)
    out = S.without_repeats(docs, length=60, gram=16)
    assert out.columns == docs.columns
    want = Counter((r[0], b[4].decode("utf-8", "ignore") if b[1] else r[1]) for r, b in zip(rows, brute([r[1] for r in rows], 60), strict=True))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want


@pytest.mark.parametrize("max_spans", [1024, 2])
def test_passages_of_a_smaller_length_are_counted_beside(make_docs, max_spans):
    rows = corpus(9, 90)
    out = S.suffix_dedup(make_docs(rows), length=90, gram=16, max_spans=max_spans, passage=40)
    assert out.columns[-1] == "n_passage_bytes"
    texts = [r[1] for r in rows]
    want = Counter((r[0], *far[:4], near[1]) for r, far, near in zip(rows, brute(texts, 90), brute(texts, 40), strict=True))
    assert Counter(tuple(r) for r in out.collect()) == want
    with pytest.raises(ValueError):
        S.suffix_dedup(make_docs(rows), length=90, passage=90)


def test_nothing_is_left_in_the_shared_folder_but_the_result(spark, make_docs):
    import os

    place = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(place))
    S.suffix_dedup(make_docs(corpus(9, 90)), length=90, gram=16).collect()
    assert sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(place)) - before) == ["dedup-cut"]


def test_empty_table(make_docs):
    assert S.suffix_dedup(make_docs([])).collect() == []
    assert S.suffix_dedup(make_docs([]), passage=200).collect() == []


def test_very_long_text(make_docs):
    rnd = random.Random(1)
    passage = "".join(rnd.choice("abcdef") for _ in range(500))
    long = "".join(rnd.choice("uvwxyz ") for _ in range(1_500_000))
    rows = [(1, long[:700_000] + passage + long[700_000:]), (2, "0" + passage + "1"), (3, "plain")]
    out = {r["doc_id"]: r for r in S.suffix_dedup(make_docs(rows)).collect()}
    assert [out[i]["n_removed"] for i in (1, 2, 3)] == [500, 500, 0] and out[2]["n_bytes"] == 502


def test_text_above_16_mib(make_docs):
    """Passages across the borders of stretches, and past what 24 bits address."""
    rnd = np.random.default_rng(3)
    text = rnd.choice(np.frombuffer(b"uvwxyz ", np.uint8), 17 << 20).tobytes().decode()
    passages = [rnd.choice(np.frombuffer(b"abcdef", np.uint8), 500).tobytes().decode() for _ in range(4)]
    at = [0, (1 << 20) - 250, (5 << 20) - 399, (16 << 20) + 12_345]
    for a, p in zip(at, passages, strict=True):
        text = text[:a] + p + text[a + 500 :]
    rows = [(1, text), (2, "0" + passages[0] + "1" + passages[1]), (3, "2" + passages[2] + "3"), (4, passages[3])]
    out = {r["doc_id"]: r for r in S.suffix_dedup(make_docs(rows)).collect()}
    assert [(out[i]["n_removed"], out[i]["n_spans"]) for i in (1, 2, 3, 4)] == [(2000, 4), (1000, 2), (500, 1), (500, 1)]
    rest = "".join(text[a:z] for a, z in zip([0] + [a + 500 for a in at], [*at, len(text)], strict=True))
    assert out[1]["n_bytes"] == 17 << 20 and out[1]["kept_sha256"] == hashlib.sha256(rest.encode()).hexdigest()


@pytest.mark.parametrize("size", [1, 50, 333])
def test_stretches_equal_brute_force(make_docs, monkeypatch, size):
    monkeypatch.setattr(S, "SLICE_BYTES", size)
    rows = corpus(9, 40)
    out = S.suffix_dedup(make_docs(rows), length=40, gram=16)
    assert Counter(tuple(r) for r in out.collect()) == Counter((r[0], *b[:4]) for r, b in zip(rows, brute([r[1] for r in rows], 40), strict=True))


def test_sorted_suffixes_and_extensions():
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 99, 600, dtype=np.uint8)
    sorter = S.SuffixSorter(data, 30)
    suffix = rnd.permutation(500)
    segment = np.sort(rnd.integers(0, 9, 500))
    out = sorter.sort(suffix, segment)
    for s in range(9):
        mine = [data[x : x + 30].tobytes() for x in out[segment == s]]
        assert mine == sorted(mine) and sorted(out[segment == s]) == sorted(suffix[segment == s])
    a, b = rnd.integers(0, 500, 50), rnd.integers(0, 500, 50)
    for x, y, e in zip(a, b, sorter.extension(a, b), strict=True):
        n = 0
        while n < 30 and data[x + n] == data[y + n]:
            n += 1
        assert n == e


def test_colliding_hashes_are_caught(monkeypatch):
    """With a hash that calls everything equal, the bytes decide."""
    monkeypatch.setattr(S.PrefixHash, "at", lambda self, a, b: np.zeros(len(a), np.uint64))
    spans = [np.frombuffer(t, np.uint8) for t in (b"abcdeX", b"abcdeY", b"vwxyzZ")]
    flags = S.repeated_starts(spans, np.array([2, 2, 2]), np.zeros(3, int), np.zeros(3, int), 5)
    assert [f.tolist() for f in flags] == [[True, False], [True, False], [False, False]]
