import numpy as np
import pytest
from pyspark.sql import functions as F

from clientcurve.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, shard int, dim int, block int, cluster int, positives int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, y, "x", 1, 2, 3, 4, 5, 6) for i, v, y in rows], SCHEMA.replace("array<float>", f"array<{kind}>"))


def expected(rows, every=10, positives=5, k=5):
    held = {}
    for i, v, y in rows:
        if i is not None and v and y is not None and all(x is not None and np.isfinite(x) for x in v):
            held[i] = min(held.get(i, (v, y)), (v, y))
    held = {i: ([int(np.floor(256 * float(x))) for x in v], y) for i, (v, y) in held.items()}
    out = []
    for a, (av, ay) in held.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(av, v, strict=True)), i, y) for i, (v, y) in held.items() if i != a and len(v) == len(av))
        for p, pid, _ in [s for s in scored if s[2] == ay][:positives]:
            band = [(s, i) for s, i, y in scored if y != ay and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(band[:k])]
    return sorted(out)


def mined(df, every=10, **options):
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("id") % every == 0, **options).collect())


def clustered(seed=1, n=400, d=10, centres=6):
    rnd = np.random.default_rng(seed)
    c = rnd.normal(0, 0.3, (centres, d))
    own = rnd.integers(0, centres, n)
    x = (c[own] + rnd.normal(0, 0.05, (n, d))).astype(np.float32)
    rows = [(i, x[i].tolist(), int(rnd.integers(0, 4)) if i % 3 else int(own[i]) % 4) for i in range(n)]
    rows += [(n + i, rows[20][1], i % 5) for i in range(150)]  # one vector over a quarter of the rows
    rows += [(5000, [0.0] * d, 1), (5010, [0.0] * d, 2), (5020, (-x[20]).tolist(), 3)]
    rows += [(5030, [1.0, 2.0], 1), (5031, [2.0, 1.0], 1), (5032, [1.5, 1.5], 0), (5040, [1.0], 7)]
    rows += [rows[20], (20, [9.0] * d, 1)]  # a repeated id
    return rows + [(None, [1.0] * d, 1), (6000, None, 1), (6010, [], 1), (6020, x[1].tolist(), None), (6030, [None] * d, 1), (6040, [float("nan")] * d, 1), (6050, [float("inf")] * d, 1)]


def test_equals_brute_force(spark):
    rows = clustered()
    got = mined(frame(spark, rows).repartition(5))
    assert got == expected(rows) and len(got) > 300


def test_many_blocks_clusters_and_shards(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_VALUES", 700)
    monkeypatch.setattr(H, "BLOCK_ROWS", 8)
    monkeypatch.setattr(H, "ANCHORS_A_CENTRE", 6)
    monkeypatch.setattr(H, "STRETCH", 16)
    rows = clustered(4)
    assert mined(frame(spark, rows)) == expected(rows)
    same = [(i, [0.5, 0.25], i % 3) for i in range(300)]  # all anchors in one cluster
    assert mined(frame(spark, same)) == expected(same)


def test_other_parameters_and_a_derived_label(spark):
    rows = clustered(2, 150)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    moved = [(i, v, (y + 1) % 10 if i is not None and y is not None and i % 7 == 0 else y) for i, v, y in rows]
    assert mined(frame(spark, rows), every=7, positives=3, k=2, label=label) == expected(moved, 7, 3, 2)


def test_values_beyond_exact_doubles(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(1, 0.2, 6) * 1e6).tolist(), i % 3) for i in range(60)]
    got = mined(frame(spark, rows, "double"))
    assert got == expected(rows) and got


def test_bounds_hold_and_walks_end_early():
    rnd = np.random.default_rng(7)
    centre = rnd.normal(0, 1, (8, 16))
    x = np.floor(256 * (centre[rnd.integers(0, 8, 4000)] + rnd.normal(0, 0.1, (4000, 16))))
    q = x[:: 500][:4] + 1
    q = np.array([q[0] + d for d in range(6)])
    bound = H.list_bounds(x, q)
    score = q @ x.T
    assert (score <= bound * np.sqrt((q * q).sum(axis=1))[:, None] * (1 + 1e-9) + 1).all()
    ids, labels = np.arange(4000), rnd.integers(0, 5, 4000)
    slot, found, s, scored = H.walk(ids, x, labels, np.arange(-6, 0), q, np.zeros(6, np.int64), 5, stretch=64)
    assert scored < 6 * 4000 / 4
    for m in range(6):
        best = sorted((-v, i) for v, i in zip(score[m], ids, strict=True) if labels[i] == 0)[:5]
        assert list(zip(-s[slot == m], found[slot == m], strict=True)) == best
    bands = np.repeat(s.reshape(6, 5), 1, axis=1)
    _, _, _, scored = H.walk(ids, x, labels, np.arange(-6, 0), q, np.zeros(6, np.int64), 5, bands, stretch=64)
    assert scored < 6 * 4000 / 4


def test_clusters_fit():
    rnd = np.random.default_rng(3)
    c = rnd.normal(0, 1, (5, 8))
    x = np.repeat(c, 40, axis=0) + rnd.normal(0, 0.02, (200, 8))
    got = H.centres(x, 5)
    assert len(got) == 5 and ((H.unit(x) @ got.T).max(axis=1) > 0.98).all()
    assert len(H.centres(np.ones((9, 3)), 4)) == 1 and len(H.centres(np.zeros((3, 2)), 2)) >= 1


def test_empty_and_anchorless_tables(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, [1.0], 0), (2, [1.0], 1)])) == []
    assert mined(frame(spark, [(10, [1.0], 0)])) == []


@pytest.mark.parametrize("seed", [11, 12])
def test_random_tables(spark, seed):
    rnd = np.random.default_rng(seed)
    rows = [(int(i), (rnd.integers(-3, 4, 3) / 4).tolist(), int(rnd.integers(-1, 3))) for i in rnd.integers(-50, 200, 150)]
    assert mined(frame(spark, rows), every=5) == expected(rows, 5)
