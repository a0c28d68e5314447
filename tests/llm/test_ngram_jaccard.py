import random
import re
from collections import Counter

import numpy as np
import pytest

from clientcurve.llm import ngram_jaccard as J
from clientcurve.llm._graph import connected_components

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORDS.findall((text or "").translate(LOWER))
    if len(w) >= n:
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, n, num, den):
    """[(id, size, smallest id of the class)] in the order of the rows."""
    sets = [shingles(r[1], n) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {}
    for r, v in zip(rows, label, strict=True):
        if r[0] is not None:
            least[v] = min(least.get(v, r[0]), r[0])
    return [(r[0], len(s), least.get(v) if s else r[0]) for r, s, v in zip(rows, sets, label, strict=True)]


def near_copies(seed, groups=6, copies=7):
    rnd, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 160))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append(" ".join(w) if rnd.random() < 0.7 else "\t".join(w).upper())
    rnd.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100)])
def test_equals_brute_force(make_docs, n, num, den):
    rows = near_copies(n) + [(5000, None), (5001, ""), (5002, "  \t\n"), (5003, ""), (None, "lone words here now then"), (None, near_copies(n)[0][1]), (3, "again other text of the id"), (5004, "One"), (5005, "one")]
    rows += [(6000, rows[0][1]), (6000, rows[0][1])]
    out = J.ngram_jaccard(make_docs(rows), n=n, num=num, den=den)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert got(out) == Counter(brute(rows, n, num, den))


def test_blocks_and_long_columns(make_docs, monkeypatch):
    """Groups cut into many blocks and columns beyond the size that is compared
    row by row give the same classes."""
    monkeypatch.setattr(J, "BLOCK_NGRAMS", 200)
    monkeypatch.setattr(J, "COLUMN_ROWS", 3)
    rows = near_copies(11, groups=3, copies=15)
    assert got(J.ngram_jaccard(make_docs(rows), n=3, num=90, den=100)) == Counter(brute(rows, 3, 90, 100))


def test_a_large_class_takes_work_in_proportion(spark, make_docs, monkeypatch):
    """Blocks of near copies of one text meet the representatives, not each other."""
    monkeypatch.setattr(J, "BLOCK_NGRAMS", 1000)
    rnd = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        words = list(base)
        words[int(rnd.integers(0, 60))] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"y{j}" for j in rnd.integers(0, 10**6, 50))) for i in range(40)]
    met = []
    real = J._block_pairs

    def counted(*a):
        met.append(real(*a))
        return met[-1]

    monkeypatch.setattr(J, "_block_pairs", counted)
    out = {r["doc_id"]: r["component_id"] for r in J.ngram_jaccard(make_docs(rows), n=3, num=80, den=100).collect()}
    assert all(out[i] == 0 for i in range(600)) and all(out[1000 + i] == 1000 + i for i in range(40))
    assert met[0].where("i < j").count() <= 10  # 35 blocks would make 595 pairs


def test_empty_table(make_docs):
    assert J.ngram_jaccard(make_docs([]), n=3, num=90, den=100).collect() == []


def test_threshold_is_met_exactly(make_docs):
    """20 shared of 22: 1000 * 20 / 22 is just above 0.909."""
    a = [f"a{i}" for i in range(23)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:22], "zz"])), (3, " ".join([*a[:21], "yy", "zz"]))]
    sizes = [len(shingles(r[1], 3)) for r in rows]
    assert sizes == [21, 21, 21]
    for num, den in ((20, 22), (201, 220)):
        assert got(J.ngram_jaccard(make_docs(rows), n=3, num=num, den=den)) == Counter(brute(rows, 3, num, den))


def test_sketches_bound_the_difference():
    rnd = np.random.default_rng(3)
    for size in (3, 900, 5000, 40_000):
        a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) * 9 // 10], rnd.integers(0, 1 << 63, size // 8 + 1, dtype=np.uint64)]))
        x = J._stacked([J.sketch(a, 80, 100), J.sketch(b, 80, 100)])
        assert np.bitwise_count(x[0] ^ x[1]).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7), (500, 501), (501, 500)]
    out = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {out[i] for i in range(41)} == {out[0]} and {out[i] for i in (100, 200, 300)} == {out[100]}
    assert out[500] == out[501] and len(set(out.values())) == 3
