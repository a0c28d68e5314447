import numpy as np
import pytest
from pyspark.sql import functions as F

from clientcurve.llm import _vectors
from clientcurve.llm.topk_nra import exact_topk, nra_block
from clientcurve.llm.vp_tree import VPTree, nearest_neighbours, unit

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, shard int, dim int, block int, score int"
BAD = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 0.0]), (904, [float("inf"), 0.0, 0.0]), (None, [1.0, 2.0, 3.0])]


def table(seed=1, n=260, d=12):
    rnd = np.random.default_rng(seed)
    rows = [(i, rnd.normal(0, 0.2, d).astype(np.float32).tolist()) for i in range(n)]
    hot = rows[3][1]
    rows += [(i, hot) for i in range(n, n + 90)]  # one vector a quarter of the rows
    rows += [(n + 100, [0.0] * d), (n + 101, [2 * x for x in rows[5][1]]), (n + 102, [1.0, 2.0]), (n + 103, [3.0, 1.0])]
    return rows + [rows[9], rows[9]] + BAD


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2, 3, 4, 5) for i, v in rows], SCHEMA)


def usable(rows):
    return {i: np.array(v, np.float64) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}


def expected(vecs, score, k, every):
    out = {}
    for q, x in vecs.items():
        if q % every == 0:
            cand = sorted((-score(x, y), i) for i, y in vecs.items() if i != q and len(y) == len(x))
            out[q] = [(i, -s) for s, i in cand[:k]]
    return {q: v for q, v in out.items() if v}


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(_vectors, "SHARD_ROWS", 120)
    monkeypatch.setattr(_vectors, "BLOCK_ROWS", 20)


def test_exact_topk(spark, small_blocks):
    rows = table()
    vecs = {i: np.floor(256 * v) for i, v in usable(rows).items()}
    got = listed(exact_topk(frame(spark, rows), F.col("id") % 7 == 0))
    assert got == expected(vecs, lambda a, b: int(a @ b), 5, 7)


def test_huge_values_stay_exact(spark):
    """Sums beyond 2**53, where doubles would round."""
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-(10**6), 10**6, 3)]) for i in range(30)]
    ints = {i: [int(x) * 256 for x in v] for i, v in rows}
    top = {q: sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ints.items() if i != q)[:5] for q, x in ints.items() if q % 10 == 0}
    got = listed(exact_topk(frame(spark, rows), F.col("id") % 10 == 0))
    assert got == {q: [(i, -s) for s, i in v] for q, v in top.items()}


def test_nearest_neighbours_exact_at_factor_one(spark, small_blocks):
    rows = table(2)
    vecs = {i: v for i, v in usable(rows).items() if v.any()}
    got = listed(nearest_neighbours(frame(spark, rows), F.col("id") % 7 == 0, factor=1.0))
    want = expected(vecs, lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), 5, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] or any(abs(a[1] - b[1]) < 1e-12 for a, b in zip(want[q], want[q][1:], strict=False))


def test_empty_tables(spark):
    for search in (exact_topk, nearest_neighbours):
        assert search(frame(spark, []), F.col("id") % 2 == 0).collect() == []
        assert search(frame(spark, BAD), F.col("id") % 2 == 0).collect() == []


def test_bounds_never_lose_a_row():
    rnd = np.random.default_rng(5)
    for n in (1, 4, 50, 400):
        x, q = rnd.integers(-50, 50, (n, 6)).astype(float), rnd.integers(-50, 50, (9, 6)).astype(float)
        left = nra_block(x, q, 5, np.full(9, -1), resolve=8, depths=(0.1, 0.3, 0.6, 1))
        for i, c in enumerate(left):
            assert set(np.argsort(-(x @ q[i]), kind="stable")[:5]) <= set(c) or n == 1


def test_reading_stops_early_on_skewed_lists():
    rnd = np.random.default_rng(6)
    x = rnd.pareto(1.5, (2000, 4))
    left = nra_block(x, np.ones((3, 4)), 5, np.full(3, -1), resolve=50, depths=(0.1, 1))
    assert all(5 <= len(c) <= 50 for c in left)


def test_recall_and_pruning_follow_the_factor():
    rnd = np.random.default_rng(7)
    centres = rnd.normal(0, 1, (20, 16))
    x = unit(centres[rnd.integers(0, 20, 3000)] + rnd.normal(0, 0.15, (3000, 16)))
    q = x[:100]
    want = np.argsort(-(q @ x.T), axis=1)[:, :6]
    recall, seen = [], []
    for factor in (1.0, 4.0, 50.0):
        tree = VPTree(x)
        got = tree.search(q, 13, factor)
        recall.append(np.mean([len(set(a) & set(b)) / 6 for a, b in zip(want, got, strict=True)]))
        seen.append(tree.visited)
    assert recall[0] == 1 and recall[1] >= 0.9 and seen[0] > seen[2] and seen[0] < 0.7 * x.shape[0] * len(q)
