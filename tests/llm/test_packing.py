"""Windows of target proportions, against a sequential deficit round-robin."""

import itertools
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from clientcurve.llm._tokens import tokenizer_path
from clientcurve.llm.packing import pack_documents, phases, pieces_of


def sequential(sizes, weights, window):
    """(queue, place in the queue) of every token, window by window. A window pays
    each queue its share and what it still owes from windows before; whole tokens are
    taken as the debts of the queues up to each one add up to them."""
    left, taken, windows = list(sizes), [0] * len(sizes), []
    owed = None
    while sum(left):
        k = [w if x else 0 for w, x in zip(weights, left, strict=True)]
        if not sum(k):
            k = left[:]
        share = [Fraction(window * x, sum(k)) for x in k]
        if owed is None or owed[0] != k:
            owed = (k, [Fraction(0)] * len(sizes))
        debt = [o + s for o, s in zip(owed[1], share, strict=True)]
        ends = [int(x // 1) for x in itertools.accumulate(debt)]
        counts = [b - a for a, b in zip([0, *ends], ends)]
        if any(c > x for c, x in zip(counts, left, strict=True)) or sum(left) < window or any(s > x and x for s, x in zip(share, left, strict=True)):
            return windows, left  # a queue ends within this window
        owed = (k, [d - c for d, c in zip(debt, counts, strict=True)])
        assert all(-1 < o < 1 for o in owed[1])  # the deficit carried is less than a token
        windows.append(counts)
        taken = [t + c for t, c in zip(taken, counts, strict=True)]
        left = [x - c for x, c in zip(left, counts, strict=True)]
    return windows, left


def counts_of(plan, sizes, window):
    out = []
    queues = np.arange(len(sizes))
    for p in plan:
        for w in range(p.windows):
            (a, b), (c, d) = (p.before(queues, np.full(len(sizes), x), window) for x in (w, w + 1))
            out.append(((d - c) - (b - a)).tolist())
    return out


CASES = [
    ([0, 700, 300, 2000], [0, 700, 300, 2000], 64),
    ([50, 900, 1100, 65], [50, 900, 1100, 65], 32),
    ([3, 4000, 997], [3, 4000, 997], 100),
    ([0, 1000, 1000, 1000], [0, 5, 2, 1], 64),
    ([10, 500, 40, 900], [1, 3, 30, 6], 50),
    ([0, 500, 300], [0, 0, 7], 40),
    ([0, 128, 128], [0, 1, 1], 64),
    ([5], [5], 64),
    ([0, 63, 1], [0, 63, 1], 64),
]


@pytest.mark.parametrize("sizes,weights,window", CASES)
def test_windows_equal_the_sequential_ones(sizes, weights, window):
    plan = phases(sizes, weights, window)
    counts = counts_of(plan, sizes, window)
    assert [sum(c) for c in counts[:-1]] == [window] * (len(counts) - 1) and 0 < sum(counts[-1]) <= window
    assert np.sum(counts, axis=0).tolist() == sizes and min(map(min, counts)) >= 0
    want, _ = sequential(sizes, weights, window)
    assert counts[: len(want)] == want
    share = [Fraction(window * w, sum(weights)) for w in weights]
    for c in want[: plan[0].windows]:
        assert all(abs(n - s) < 2 for n, s in zip(c, share, strict=True))


@pytest.mark.parametrize("sizes,weights,window", CASES)
def test_pieces_equal_a_token_by_token_deal(sizes, weights, window):
    rnd = np.random.default_rng(3)
    queue, begin, size = [], [], []
    for j, n in enumerate(sizes):
        at = 0
        while at < n:
            d = int(min(n - at, rnd.integers(1, 150)))
            queue, begin, size = [*queue, j], [*begin, at], [*size, d]
            at += d
    plan = phases(sizes, weights, window)
    place, at = {}, [0] * len(sizes)
    for w, counts in enumerate(counts_of(plan, sizes, window)):
        off = 0
        for j, n in enumerate(counts):
            for _ in range(n):
                place[j, at[j]] = (w, off)
                at[j] += 1
                off += 1
    got = {}
    for d, first, n, w, off in zip(*pieces_of(np.array(queue), np.array(begin), np.array(size), plan, sizes, window), strict=True):
        assert n > 0
        for i in range(n):
            key = (queue[d], begin[d] + first + i)
            assert key not in got
            got[key] = (w, off + i)
    assert got == place


def test_plans_beyond_64_bits():
    sizes = [7, 6 * 10**13 + 11, 3 * 10**12, 10**13 + 1]
    plan = phases(sizes, sizes, 4096)
    assert plan[0].windows == sum(sizes) // 4096
    total, upto = sum(sizes), [0, *itertools.accumulate(sizes)]
    for w in (0, 1, 10**9, plan[0].windows):
        low, high = plan[0].before(np.arange(4), np.full(4, w), 4096)
        assert low.tolist() == [w * 4096 * u // total for u in upto[:-1]] and high.tolist() == [w * 4096 * u // total for u in upto[1:]]
    begin = np.array([10**13 + 5])
    d, first, n, w, off = pieces_of(np.array([1]), begin, np.array([9000]), plan, sizes, 4096)
    assert n.sum() == 9000 and first.tolist() == (np.cumsum(n) - n).tolist() and (np.diff(w) == 1).all()


def texts(rnd, n, words=60):
    return [(i, " ".join(f"w{x}" for x in rnd.integers(0, 50, rnd.integers(1, words))), f"s{rnd.choice(6, p=[0.5, 0.2, 0.15, 0.1, 0.04, 0.01])}") for i in range(n)]


def read(out):
    windows = defaultdict(Counter)
    for p in out:
        windows[p["sequence_id"]][p["source"]] += p["length"]
    return windows


def test_every_full_window_has_the_target_proportions(spark, make_docs):
    rows = [*texts(np.random.default_rng(1), 600), (None, "w1 w2", None), (5000, "w3 " * 9000, "s0")]
    out = pack_documents(make_docs(rows).repartition(7), tokenizer_path("word_bpe_49k.json"), end_id=2, window=128).collect()
    share = Counter()
    for p in out:
        share[p["source"]] += p["length"]
    total, windows = sum(share.values()), read(out)
    own = {s for s, n in share.items() if 128 * n >= total}
    assert len(own) >= 5
    for w in range(total // 128):
        for s in own:
            assert abs(windows[w][s] - 128 * share[s] / total) < 2


def test_weights_hold_while_the_queues_last(spark, make_docs):
    rows = texts(np.random.default_rng(2), 400)
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 2.0), ("s2", 1.0), ("unseen", 9.0)], "source string, weight double")
    out = pack_documents(make_docs(rows), tokenizer_path("word_bpe_49k.json"), end_id=2, window=64, weights=weights).collect()
    windows, share = read(out), Counter()
    for p in out:
        share[p["source"]] += p["length"]
    assert len(share) == 6  # sources without a weight are packed too, last
    last = min(int(share[s] / x / 64) for s, x in (("s0", 0.25), ("s1", 0.5), ("s2", 0.25))) - 1
    assert last > 5
    for w in range(last):
        assert all(abs(windows[w][s] - 64 * x) < 2 for s, x in (("s0", 0.25), ("s1", 0.5), ("s2", 0.25)))
    assert sum(n for w in windows.values() for n in w.values()) == sum(share.values())


def test_many_small_sources_share_a_queue(spark, make_docs):
    rows = [(i, f"w{i} w2 w3", f"host{i % 300}") for i in range(900)] + [(2000 + i, "w1 " * 30, "big") for i in range(100)]
    out = pack_documents(make_docs(rows), tokenizer_path("word_bpe_49k.json"), end_id=2, window=64, quantum=8).collect()
    total, windows = sum(p["length"] for p in out), read(out)
    big = sum(p["length"] for p in out if p["source"] == "big")
    for w in range(total // 64):
        assert abs(windows[w]["big"] - 64 * big / total) < 2
    # Inside the common queue each host gives its documents in turn.
    firsts = [p for p in sorted(out, key=lambda p: (p["sequence_id"], p["offset"])) if p["source"] != "big" and p["start"] == 0]
    assert len({p["source"] for p in firsts[:300]}) == 300
