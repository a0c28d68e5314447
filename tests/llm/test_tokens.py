"""Token ids, directly addressable codes and packing, against the library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clientcurve.llm._tokens import Encoder, tokenizer_path
from clientcurve.llm.packing import pack_documents
from clientcurve.llm.token_codes import DirectCodes, encode_segment, read_codes, token_at, write_codes
from clientcurve.session import shared_path

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TEXTS = [
    "", "\n", " x", "x ", "x\n", "\nx", "a  b \n c\n\nd   e\tf", "<|endoftext|> x <|startoftext|>", "İstanbul ΑΣ ﬁ 漢字 é́ 🙂 it's don't 1234 ¼²",
    "it's 'tis we'll I'D 'S x\x1cy", "Mañana, über? naïve: ÀÉ! (ok) a|b #1 50% x&y", "foo \nbar", "foo\n bar", " x­ y z", "word. " * 50,
]
ENCODERS = {n: Encoder(tokenizer_path(n)) for n in NAMES}
LIBRARY = {n: Tokenizer.from_file(tokenizer_path(n)) for n in NAMES}
for t in LIBRARY.values():
    t.encode_special_tokens = True


def ids_of(name, text):
    return LIBRARY[name].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_same_ids_as_the_library(name):
    for text in TEXTS:
        assert np.frombuffer(ENCODERS[name].encode(text), np.uint16).tolist() == ids_of(name, text), text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcÉß ñ'st.,!1²\n \t|ª", max_size=60))
def test_same_ids_on_any_text(text):
    for name in NAMES:
        assert np.frombuffer(ENCODERS[name].encode(text), np.uint16).tolist() == ids_of(name, text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.data())
def test_codes_round_trip_and_random_access(ids, data):
    codes = DirectCodes(encode_segment(np.array(ids, np.uint32)))
    assert len(codes) == len(ids) and codes.slice(0, len(ids)).tolist() == ids
    if ids:
        i = data.draw(st.integers(0, len(ids) - 1))
        j = data.draw(st.integers(i, len(ids)))
        assert codes.get(i) == ids[i] and codes.slice(i, j).tolist() == ids[i:j]


ROWS = [(i, t * (1 + i % 3), f"s{i % 4}") for i, t in enumerate(TEXTS)] + [(None, "no id", None), (3, "repeated id", "s1"), (3, "repeated id", "s1"), (50, None, "s0"), (51, "long text of words " * 6000, "s0")]


def test_written_files_give_every_document_back(spark, make_docs):
    path = shared_path(spark, "codes-test")
    write_codes(make_docs(ROWS), path, tokenizer_path(NAMES[0]), end_id=2, segment_tokens=300)
    out = sorted(read_codes(spark, path).collect(), key=lambda r: r["start"])
    want = Counter((r[0], len(x := ids_of(NAMES[0], r[1]) + [2]), zlib.crc32(np.array(x, "<u4").tobytes())) for r in ROWS)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    assert [r["start"] for r in out] == np.cumsum([0, *(r["n_tokens"] for r in out)])[:-1].tolist()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids)
    one = spark.read.parquet(path).where("tokens > 100").first()
    assert token_at(spark, path, one["part"], one["seg"], 77) == DirectCodes(bytes(one["codes"])).slice(77, 78)[0]


def test_pieces_cover_every_document_and_fill_windows(spark, make_docs):
    out = pack_documents(make_docs(ROWS), tokenizer_path(NAMES[1]), end_id=2, window=64, quantum=16, with_ids=True).collect()
    docs, seen, sequences = defaultdict(list), Counter(), defaultdict(list)
    for r in ROWS:
        docs[r[0]].append(ids_of(NAMES[1], r[1]) + [2])
    for p in out:
        got = np.frombuffer(p["ids"], "<u4").tolist()
        assert any(len(d) == p["doc_tokens"] and d[p["start"] : p["start"] + p["length"]] == got for d in docs[p["doc_id"]])
        assert len(got) == p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        seen[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"], p["source"]))
    assert seen == Counter({k: sum(map(len, v)) for k, v in docs.items()})
    lengths = []
    for s in sorted(sequences):
        at = 0
        for off, n, _ in sorted(sequences[s], key=lambda x: x[:2]):
            assert off == at
            at += n
        lengths.append(at)
    total = sum(seen.values())
    assert lengths[: total // 64] == [64] * (total // 64) and all(n & (n - 1) == 0 for n in lengths)
    # Every run of windows has each source's share, up to a quantum at either end.
    share = Counter()
    for p in out:
        share[p["source"]] += p["length"]
    for lo in range(0, total // 64 - 20, 10):
        have = Counter()
        for s in range(lo, lo + 20):
            for _, n, source in sequences[s]:
                have[source] += n
        for source, n in share.items():
            assert abs(have[source] - 20 * 64 * n / total) <= 2 * 16 + 16


def test_empty_tables(spark, make_docs):
    path = shared_path(spark, "codes-empty")
    write_codes(make_docs([]), path, tokenizer_path(NAMES[0]), end_id=2)
    assert read_codes(spark, path).collect() == []
    assert pack_documents(make_docs([]), tokenizer_path(NAMES[1]), end_id=2).collect() == []
