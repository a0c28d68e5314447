import random

import pytest

from clientcurve.llm.mixing import mix_sources, mixed, source_targets


def fill(sizes, weights, budget, most):
    """Caps and resharing, step by step."""
    target, free = {}, dict(zip(sizes, weights, strict=True))
    while free:
        left = budget - sum(target.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            del free[s]
    return target


@pytest.mark.parametrize("seed", range(2))
def test_targets_by_resharing(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": rnd.choice([0, 1, 10, 1000, 50_000]) + rnd.randrange(9) for i in range(11)}
    weights = [(5, 2, 1)[i % 3] for i in range(11)]
    order = sorted(sizes)
    want = fill({s: sizes[s] for s in order}, weights, 1.5 * sum(sizes.values()), 2)
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows, (5, 2, 1), 1.5, 2).collect()}
    assert got == {s: pytest.approx(want[s]) for s in order}


def test_mix(make_docs):
    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 40)), rnd.choice(["hot", "hot", "b", "c", None, "é"])) for i in range(900)]
    rows += [(1000, None, "b"), (1001, "", "b"), (None, "x y", "c"), (7, "again", "c"), (7, "again", "c"), (2000, None, "only empty")]
    docs = make_docs(rows)
    out = mix_sources(docs).collect()
    assert len(out) == len(rows)
    taken = {}
    for r in out:
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] and r["target"] <= 2 * r["source_size"]
        t = taken.setdefault(r["source"], [0, r["target"]])
        t[0] += r["taken"]
    assert all(abs(a - t) <= 20 for a, t in taken.values())  # half of the largest document
    again = {(r["doc_id"], r["size"], r["source"], r["taken"]) for r in mix_sources(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["size"], r["source"], r["taken"]) for r in out}
    whole = mixed(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r["copies"] for r in out)


@pytest.mark.parametrize("key", [7, None])
def test_the_threshold_falls_among_equal_rows(make_docs, key):
    """Fifty equal rows hold nearly all of a source's words."""
    rows = [(key, "w " * 1000, "a")] * 50 + [(100 + i, "v " * 10, "a") for i in range(100)] + [(300 + i, "u " * 10, "b") for i in range(40)]
    docs = make_docs(rows).repartition(5)
    for _ in range(2):
        out = mix_sources(docs).collect()
        assert len(out) == len(rows)
        for source in ("a", "b"):
            mine = [r for r in out if r["source"] == source]
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 500
    equal = [r["copies"] for r in out if r["size"] == 1000]
    assert len(equal) == 50 and max(equal) - min(equal) <= 1
    assert mixed(docs).where("source = 'a'").count() == sum(r["copies"] for r in out if r["source"] == "a")


def test_empty_table(make_docs):
    assert mix_sources(make_docs([])).collect() == [] and mixed(make_docs([])).collect() == []
