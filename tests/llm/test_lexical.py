import math
import re
from collections import Counter

import numpy as np
import pytest

from clientcurve.llm import lexical_bags as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, item string, term int, block int, score int"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=50):
    rows = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    rows = [r for r in rows if r[2]]
    n_docs, total = len(rows), sum(r[2] for r in rows)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in rows) + 1))) for t in terms}
        found = []
        for doc, c, n in rows:
            m = 100 - 50 + 50 * n * n_docs // total
            score = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return out


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], ITEMS)


def ranked(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def case(seed=3, n=300):
    rnd = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "été", "日本", "A1b2"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    weights /= weights.sum()

    def text(size):
        return " ".join(rnd.choice(vocabulary, size, p=weights))

    docs = [(i, text(int(rnd.integers(1, 40)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(150)]  # a text that a third of the documents share
    docs += [(2 * n + i, "  ".join(reversed(docs[7][1].split()))) for i in range(20)]  # the same bag in another order
    docs += [(5000 + i, f"only{i} w3 w3") for i in range(70)]  # texts that differ outside the vocabulary
    docs += [(-5, "w1 w2"), (None, "w1 w2"), (None, None), (6000, None), (6001, ""), (6002, " .,;\t\x00"), docs[3], docs[3]]
    docs += [(6003, "W1.w2,A1B2\x00w4 w5 Straße"), (6004, "w9 " * 30_000)]
    asked = [(i, text(8)) for i in range(12)] + [(100, "w1 w1 W1"), (101, None), (102, "..."), (103, "nowhere"), (104, "Straße ÉTÉ 日本")]
    return docs, asked + [(0, "w3"), (None, "w5 w6")]


@pytest.mark.parametrize("block_terms", [B.BLOCK_TERMS, 20])
def test_equals_brute_force(spark, make_docs, block_terms):
    docs, asked = case()
    got = ranked(B.ranked_search(make_docs(docs).repartition(6), items(spark, asked), block_terms=block_terms))
    assert got == sorted(expected(docs, asked), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_few_results_and_ties(spark, make_docs):
    docs, asked = case(5, 40)
    got = ranked(B.ranked_search(make_docs(docs), items(spark, asked), k=3))
    assert got == sorted(expected(docs, asked, 3), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_a_class_is_scored_once(spark, make_docs, monkeypatch):
    """Copies reach the scorer as members of one class."""
    docs = [(i, "w1 w2 w3 . " if i % 2 else "w3 w2 w1") for i in range(500)] + [(900, "w1")]
    got = ranked(B.ranked_search(make_docs(docs), items(spark, [(1, "w1 w2 w9")])))
    assert [r[2] for r in got] == list(range(50))
    scored = []
    run = B._scorer([1], np.array([5, 7], np.int64), np.array([0, 1, 2]), np.array([0, 0]), 50)
    import pyarrow as pa

    bag = np.array([[0, 2], [1, 1]], "<u4").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([3, 8, 9]), pa.array([100] * 3), pa.array([1, 2, 3]), pa.array([bag, None, None], pa.binary())], names=["id", "m", "r", "bag"])
    for out in run(iter([batch.slice(0, 2), batch.slice(2)])):  # a class over two batches
        scored += out.to_pylist()
    assert scored == [{"item_id": 1, "score": 5 * (2 * 10**9 // 4000) + 7 * (10**9 // 3000), "first": 3, "members": [3, 8, 9]}]


def test_terms_of_bytes_are_those_of_characters():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        text = "".join(chr(c) for c in rnd.choice([*range(128), 0xA0, 0xC9, 0x3000, 0x1F600, 0x2028, 0x85], 60))
        assert [t.decode() for t in B.terms(text.encode())] == words(text)


def test_empty_tables(spark, make_docs):
    docs, asked = case(2, 20)
    assert B.ranked_search(make_docs([]), items(spark, asked)).collect() == []
    assert B.ranked_search(make_docs(docs), items(spark, [])).collect() == []
    assert B.ranked_search(make_docs([(1, None), (2, " ")]), items(spark, asked)).collect() == []
