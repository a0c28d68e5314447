import random
import zlib

import numpy as np

from clientcurve.llm import quality_cnn as Q
from clientcurve.llm.quality_cnn import CHUNK, Net, chunks_of, fit, fitted, quality_scores, training_sample


def sample(n, seed):
    rnd, out = random.Random(seed), []
    words = ["the", "over", "and", "reason", "ply", "ations", "of", "under"]
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randrange(5, 300))]
        kind = rnd.choice(["good", "good", "good", "shout", "repeat"])
        text = " ".join(w) if kind == "good" else "!! ".join(w).upper() if kind == "shout" else " ".join(x for x in w[:20] for _ in range(8))
        out.append((i, text, int(kind == "good")))
    return out


def test_chunks_cover_every_byte_and_overlap():
    rnd = np.random.default_rng(1)
    for n in (0, 1, CHUNK, CHUNK + 1, 5000):
        data = rnd.integers(0, 256, n, dtype=np.uint8)
        chunks, doc = chunks_of(data, np.array([0, n]))
        plain = np.where(chunks >= 257, chunks - 257, chunks)
        seen = np.zeros(n, bool)
        for i, c in enumerate(plain):
            part = c[c < 256]
            assert np.array_equal(part, data[i * 448 : i * 448 + len(part)])
            seen[i * 448 : i * 448 + len(part)] = True
        assert seen.all() and (len(doc) == 0) == (n == 0)


def test_gradients_match_differences():
    net = Net()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [b"some text here " * 50, b"XX!! YY!! " * 20]
    chunks, doc = chunks_of(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    labels = np.array([1.0, 0.0])

    def loss():
        z = net.logits(net.features(net.respond(chunks), doc, 2))
        return float(np.mean(np.log1p(np.exp(-z)) + (1 - labels) * z))

    grads = net.gradients(chunks, doc, labels)
    rnd = np.random.default_rng(0)
    for k in ("filters", "out", "bias", "b"):
        flat = net.p[k].ravel()
        for i in rnd.integers(0, len(flat), 4):
            old, step = flat[i], 1e-4
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - grads[k].ravel()[i]) < 5e-3


def test_held_out_accuracy():
    """Documents it never saw, repeats of words it never saw among them."""
    rows = sample(700, 1)
    net = fit([t.encode() for _, t, _ in rows[:500]], np.array([q for *_, q in rows[:500]], float), epochs=6)
    test = rows[500:] + [(0, " ".join(w for w in ("zebra", "quorum", "vexing") for _ in range(30)), 0)]
    data = [t.encode() for _, t, _ in test]
    s = net.score(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert np.mean((s >= 0.3) == [q == 1 for *_, q in test]) >= 0.97


def test_scores_do_not_depend_on_slicing():
    net = Net()
    data = [t.encode() for _, t, _ in sample(20, 3)] + [b"", b"x" * 40_000]
    whole = net.score(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    alone = [net.score(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[0] for d in data]
    assert np.allclose(whole, alone, atol=1e-5)


def test_query_on_odd_rows(spark, make_docs):
    rows = sample(150, 5)
    docs = make_docs([(i, t) for i, t, _ in rows] + [(None, "null id"), (500, None), (501, ""), (3, rows[3][1]), (502, "long " * 30_000)])
    labels = spark.createDataFrame([(i, q, 0, "x") for i, _, q in rows] + [(None, 1, 0, "x"), (3, None, 0, "x"), (7, 5, 0, "x")], "doc_id long, quality int, toxic int, text string")
    texts, marks = training_sample(docs, labels, "doc_id", "text", "quality", 60, 1 << 20)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    learned = {t for i, t, _ in rows if i not in held}
    assert len(texts) == 60 and {t.decode() for t in texts} <= learned and set(marks.tolist()) <= {0.0, 1.0}
    out = quality_scores(docs, fitted(docs, labels, sample_rows=60)).collect()
    assert len(out) == 155 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)
    assert len({r["score"] for r in out if r["doc_id"] in (500, 501)}) == 1
    nothing = fitted(docs, labels.limit(0))
    assert {r["score"] for r in quality_scores(docs, nothing).collect()} == {0.5}
    assert quality_scores(make_docs([]), nothing).collect() == []


def test_sample_passes_over_texts_that_do_not_fit(spark, make_docs):
    """A too long text at any place in the order of hashes costs only itself."""
    texts = {i: f"text {i} " * 5 for i in range(40)}
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    every = sorted(training_sample(make_docs(list(texts.items())), labels, "doc_id", "text", "quality", 100, 10_000)[0])
    for long in [i for i in texts if texts[i].encode() in every][:3]:
        docs = make_docs([(i, t if i != long else t * 1000) for i, t in texts.items()])
        got, y = training_sample(docs, labels, "doc_id", "text", "quality", 100, 10_000)
        assert sorted(got) == [t for t in every if t != texts[long].encode()] and len(y) == len(got)


def test_long_texts_are_scored_in_blocks():
    import tracemalloc

    rnd, net = np.random.default_rng(4), Net()
    for n in (1 << 18, (1 << 18) + 1, 512 * 448 * 2 + 64, 512 * 448 * 2 + 65, 1_000_003):
        data = rnd.integers(97, 120, n, dtype=np.uint8)
        chunks, doc = chunks_of(data, np.array([0, n]))
        peaks = np.concatenate([net.respond(chunks[i : i + 512]) for i in range(0, len(chunks), 512)])
        assert net.score(data, np.array([0, n]))[0] == 1 / (1 + np.exp(-net.logits(net.features(peaks, doc, 1)).astype(np.float64)))[0]
    data = rnd.integers(97, 120, 8 << 20, dtype=np.uint8)
    tracemalloc.start()
    net.score(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * len(data)


def naive_score(net, text):
    """The network byte by byte, chunk by chunk and filter by filter."""
    embed, filters, bias, out = (net.p[k].astype(np.float64) for k in ("embed", "filters", "bias", "out"))
    peaks, start = [], 0
    while start == 0 or start < len(text) - (Q.CHUNK - Q.STEP):
        if not text:
            break
        chunk = text[start : start + Q.CHUNK]
        codes = []
        for i in range(Q.CHUNK):
            if i >= len(chunk):
                codes.append(Q.PAD)
                continue
            echo = any(i - 3 - lag >= 0 and chunk[i - 3 : i + 1] == chunk[i - 3 - lag : i + 1 - lag] for lag in Q.LAGS)
            codes.append(chunk[i] + Q.ECHO * echo)
        best = np.zeros(Q.FILTERS)
        for at in range(0, Q.CHUNK - Q.HOP, Q.HOP):
            if codes[at] == Q.PAD:
                continue
            for f in range(Q.FILTERS):
                total = bias[f]
                for b in range(Q.HOP):
                    for e in range(Q.EMBED):
                        total += embed[codes[at + b], e] * filters[b * Q.EMBED + e, f]
                        total += embed[codes[at + Q.HOP + b], e] * filters[b * Q.EMBED + e, Q.FILTERS + f]
                best[f] = max(best[f], total)
        peaks.append(best)
        start += Q.STEP
    features = np.concatenate([np.mean(peaks, axis=0), np.max(peaks, axis=0)]) if peaks else np.zeros(2 * Q.FILTERS)
    return 1 / (1 + np.exp(-(features @ out + float(net.p["b"][0]))))


def test_scores_equal_a_naive_convolution():
    rnd = np.random.default_rng(8)
    net = Q.Net(3)
    net.p["bias"][:] = rnd.normal(0, 0.3, Q.FILTERS)
    net.p["b"][0] = 0.2
    texts = [b"", b"x", b"abab abab abab", bytes(rnd.integers(0, 256, 700)), ("né " * 250).encode(), bytes(rnd.integers(97, 100, 512))]
    off = np.cumsum([0, *map(len, texts)])
    got = net.score(np.frombuffer(b"".join(texts), np.uint8), off)
    assert np.allclose(got, [naive_score(net, t) for t in texts], atol=1e-4)
