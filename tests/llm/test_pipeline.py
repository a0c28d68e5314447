"""The pipeline on the smallest tables, stage by stage, against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from clientcurve.llm import queries as Q
from clientcurve.llm._common import stored
from clientcurve.llm.quality_cnn import fitted

from .test_ngram_jaccard import brute as classes
from .test_suffix_dedup import brute as cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from clientcurve.llm._common import ship

    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        docs = stored(stage(spark, docs, SF), f"test-stage-{i}")
        out.append(docs)
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "suffix-array dedup", "mixing sources to target weights", "packing"]
    assert "pipeline" in Q.queries() and P.ORACLE_SQL is None


def test_quality(spark, stages):
    docs = stages[0].collect()
    net = fitted(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    keep = Counter()
    for r in docs:
        t = (r["text"] or "").encode()
        if net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] >= 0.3:
            keep[tuple(r)] += 1
    assert rows(stages[1]) == keep and 0 < sum(keep.values()) < len(docs)
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    assert len(good - kept) <= 0.03 * len(good)


def test_near_copies(stages):
    docs = stages[1].collect()
    keep = {i for i, _, c in classes([(r["doc_id"], r["text"]) for r in docs], 5, 80, 100) if i == c}
    assert rows(stages[2]) == Counter(tuple(r) for r in docs if r["doc_id"] in keep)


def test_repeats(stages):
    docs = stages[2].collect()
    want = Counter()
    for r, c in zip(docs, cut([r["text"] for r in docs], P.REPEAT_BYTES), strict=True):
        text = c[4].decode("utf-8", "ignore") if c[1] else r["text"]
        want[(r["doc_id"], text, r["lang"], r["source"], len(text))] += 1
    assert rows(stages[3]) == want


def test_mix(stages):
    docs = stages[3].collect()
    size = {r["doc_id"]: len(re.findall("[^\x20\x09-\x0d]+", r["text"])) for r in docs}
    sources = sorted({r["source"] for r in docs})
    total = {s: sum(size[r["doc_id"]] for r in docs if r["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * total[s], mid * weight[s]) for s in sources) < 1.5 * sum(total.values()) else (lo, mid)
    want = Counter()
    for s in sources:
        target = min(2 * total[s], hi * weight[s])
        if abs(target - 2 * total[s]) < 1e-6:
            target = 2 * total[s]
        whole = math.floor(target / total[s]) if total[s] else 0
        rest, upto = target - whole * total[s], 0
        mine = [r for r in docs if r["source"] == s]
        mine.sort(key=lambda r: hashlib.md5(f"{r['doc_id']}:{hashlib.md5(r['text'].encode()).hexdigest()}".encode()).hexdigest()[:12])
        for r in mine:
            n = size[r["doc_id"]]
            more = upto + n <= rest or (upto <= rest and upto + n - rest < rest - upto)
            upto += n
            if whole + (more and rest > 0):
                want[tuple(r)] += whole + (more and rest > 0)
    assert rows(stages[4]) == want


def test_pack(stages):
    from .test_tokens import ids_of

    want, have, sequences = Counter(), Counter(), defaultdict(int)
    for r in stages[4].collect():
        want[r["doc_id"]] += len(ids_of("word_bpe_49k.json", r["text"])) + 1
    for p in stages[5].collect():
        have[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]] += p["length"]
    assert have == want
    full = sum(want.values()) // 4096
    assert all(sequences[i] == 4096 for i in range(full)) and all(n & (n - 1) == 0 for n in sequences.values())


def test_columns_and_odd_rows(spark, make_docs, stages):
    """Nulls, empty and repeated rows and an empty table pass every stage."""
    rows_ = [(1, "plain words that stand here for a test of the stages"), (1, "plain words that stand here for a test of the stages"), (2, None), (3, ""), (None, "no id for this one"), (4, "word " * 9000)]
    for docs in (make_docs(rows_), make_docs([])):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for i, (_, stage) in enumerate(P.STAGES):
            if i:
                out = stage(spark, docs, SF)
                assert i == 4 or out.columns == docs.columns
                out.count()


def test_extra_columns_of_any_name(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    names = ["ID", "text_hash", "key", "first", "rows", "doc", "s", "source_size", "grp", "begin", "n", "m", "edge", "times"]
    rows_ = [(1, a, "en", "x", 9), (1, a, "en", "x", 9), (2, a, "en", "y", 9), (None, b, "en", None, 9), (4, None, "en", "x", 0)]
    docs = spark.createDataFrame([(*r, *["z"] * len(names)) for r in rows_], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    for i, (_, stage) in enumerate(P.STAGES):
        if i:
            out = stage(spark, docs, SF)
            assert i == 4 or out.columns == docs.columns
            kept = out.collect()
            if i == 1:
                assert sorted(str(r["doc_id"]) for r in kept) == ["1", "4", "None"]


def test_near_copies_by_row(spark, make_docs):
    """Ids that repeat with other texts, null ids and rows that repeat."""
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcde")
    rows_ = [(1, a), (2, a), (2, b), (3, b + " more"), (None, c), (None, c), (None, c + " more"), (4, d), (4, d), (5, d), (6, e), (None, e), (7, None), (7, None), (8, ""), (8, "")]
    docs = make_docs(rows_).select("doc_id", "text", "lang", "source", "n_chars")
    got = Counter((r["doc_id"], r["text"]) for r in P.near_copies(spark, docs, SF).collect())
    of_c = [k for k in got if k[0] is None]
    assert len(of_c) == 1 and got.pop(of_c[0]) == 1 and of_c[0][1] in (c, c + " more")
    assert got == Counter([(1, a), (2, b), (4, d), (6, e), (7, None), (7, None), (8, ""), (8, "")])
