"""Ranked lexical search (operator 12): bag deduplication.

Every document is ranked for every item by a whole-number score:

    term        a maximal run of ASCII letters and digits and of other than ASCII
                characters, A-Z lower-cased
    N, L        documents with a term; all their terms, repeats counted
    n, tf, df   a document's terms; a term's occurrences in it; documents with the term
    w           floor(1000 * ln((2 N + 2) / (2 df + 1))), in doubles
    m           100 - 50 + ((50 n N) div L)
    score       sum over the item's distinct terms of w * ((10^9 tf) div (1000 tf + 20 m))

1. A document is restricted to the items' vocabulary: what is left of it is n and
   the counts of its vocabulary terms. Only this leaves the scan.
2. N, L and df are sums over the restricted documents; they fix w and m.
3. Documents equal in tf-vector and m score alike for every item. They are grouped
   by a 64-bit hash, and told apart by the bytes of vector and m themselves, which
   are part of the grouping key. A class keeps its ``k`` smallest ids: no other
   member can be among an item's ``k``, for these precede it. Spark applies that
   limit in each task before it shuffles, so a text that a third of all documents
   share sends ``k`` rows a task.
4. Each class is scored once, against an inverted list of the items of each term.
   A task keeps ``k`` classes an item, by score and smallest id: of the classes
   before one, each has a document that precedes all of its members.
5. Classes are ranked across tasks, the kept ones expanded to their members by
   ascending id, and these ranked.

Items go in blocks of about ``block_terms`` (item, term) pairs, or one item; a
block's vocabulary and lists, some megabytes, are all that is sent to every task.
Each block reads the documents once.

Defined cases: null and empty texts, and those without terms, count in neither N
nor L, and are never found; null ids come last among equal scores; rows that repeat
an id are documents of their own; rows of one item id are one item with the terms
of all; a null item id is an item; items without terms, and empty tables, give no
rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import mapped, stored

BLOCK_TERMS = 1 << 18
_LAST = np.iinfo(np.int64).max  # where a null id stands


def _fold(b: int) -> int:
    if 65 <= b <= 90:
        return b + 32
    return b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32


# Bytes of terms stay, A-Z are lowered, all others become spaces. In UTF-8 the bytes
# of a character beyond ASCII are all above 127, so bytes do for characters.
_FOLD = bytes(map(_fold, range(256)))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, term)``, distinct."""

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0), b.column(1), strict=True):
                own = sorted(set(terms(text.as_py() or b"")))
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["item", "term"])

    rows = items.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return stored(mapped(rows, run, "item long, term binary").distinct(), "lexical-items")


def _restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(id, n, bag)`` of the documents with a term: ``bag`` holds pairs of term
    number and count, ascending, as unsigned 32-bit values."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids, sizes, bags = [], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    found = terms(text.as_py() or b"")
                    if found:
                        counts = Counter(map(vocabulary.get, found))
                        counts.pop(None, None)
                        ids.append(key)
                        sizes.append(len(found))
                        bags.append(np.array(sorted(counts.items()), "<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["id", "n", "bag"])

    return stored(mapped(docs, run, "id long, n long, bag binary"), "lexical-bags")


def _document_counts(bags: DataFrame, size: int) -> np.ndarray:
    """df of every vocabulary term; each task sends a row a term."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            data = b"".join(x.as_py() for x in batch.column(0))
            df += np.bincount(np.frombuffer(data, "<u4")[::2], minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in mapped(bags.select("bag"), run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class _Best:
    """The ``k`` best classes of every item, by score and smallest id."""

    def __init__(self, items: int, k: int):
        self._items, self._k = items, k
        self._kth = np.zeros(items, np.int64)  # scores start above 0
        self._kth_first = np.full(items, -1, np.int64)
        self._pool = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, first id, class
        self._members: dict[int, list] = {}
        self._classes = 0

    def add(self, scores: np.ndarray, members: list[list]) -> None:
        first = np.array([_LAST if m[0] is None else m[0] for m in members], np.int64)
        good = (scores > self._kth) | ((scores == self._kth) & (first[:, None] < self._kth_first))
        c, item = np.nonzero(good & (scores > 0))
        for i in np.unique(c).tolist():
            self._members[self._classes + i] = members[i]
        new = (item, scores[c, item], first[c], c + self._classes)
        self._classes += len(members)
        self._pool = [np.concatenate(x) for x in zip(self._pool, new, strict=True)]
        if len(self._pool[0]) > 4 * self._k * self._items:
            self._prune()

    def _prune(self) -> None:
        item, score, first, _ = self._pool
        order = np.lexsort((first, -score, item))
        item, score, first, _ = self._pool = [x[order] for x in self._pool]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self._k - 1
        self._kth[item[last]], self._kth_first[item[last]] = score[last], first[last]
        self._pool = [x[place < self._k] for x in self._pool]
        kept = set(self._pool[3].tolist())
        self._members = {c: m for c, m in self._members.items() if c in kept}

    def rows(self):
        self._prune()
        for item, score, first, c in zip(*(x.tolist() for x in self._pool), strict=True):
            yield item, score, first, self._members[c]


def _scorer(ids: list, weights: np.ndarray, starts: np.ndarray, listed: np.ndarray, k: int):
    """Scores the classes of a partition, sorted with a class's rows together."""
    items = len(ids)
    # Sums of doubles are exact below 2**53; a part of a score is at most w * 10**6.
    exact = float(weights.max(initial=0)) * 1e6 * max(np.bincount(listed, minlength=1).max(initial=0), 1) < 2**53
    held = max(1, min(512, (1 << 22) // max(items, 1)))

    def score(bags: list[bytes], ms: list[int]) -> np.ndarray:
        out = np.zeros(len(bags) * items, np.int64)
        flat = np.frombuffer(b"".join(bags), "<u4").astype(np.int64)
        term, tf = flat[::2], flat[1::2]
        owner = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
        part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.array(ms, np.int64)[owner]))
        fan = starts[term + 1] - starts[term]
        ends = np.cumsum(fan)
        lo = 0
        while lo < len(term):  # a stretch of (class, term) pairs whose lists hold about 2**21 items
            base = ends[lo] - fan[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + (1 << 21), side="right")))
            f = fan[lo:hi]
            pair = np.repeat(np.arange(lo, hi), f)
            at = np.arange(len(pair)) - np.repeat(ends[lo:hi] - f - base, f) + starts[term[pair]]
            cell = owner[pair] * items + listed[at]
            if exact:
                out += np.bincount(cell, part[pair], len(out)).astype(np.int64)
            else:
                np.add.at(out, cell, part[pair])
            lo = hi
        return out.reshape(len(bags), items)

    def run(batches):
        best = _Best(items, k)
        bags, ms, members = [], [], []

        def settle():
            if bags:
                best.add(score(bags, ms), members)
                bags.clear(), ms.clear(), members.clear()

        for batch in batches:
            for key, m, rank, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if rank == 1:
                    if len(bags) >= held:
                        settle()
                    bags.append(bag.as_py())
                    ms.append(m)
                    members.append([])
                members[-1].append(key)
        settle()
        names, out = ["item_id", "score", "first", "members"], []
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        for item, s, first, own in best.rows():
            out.append((ids[item], s, first, own))
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


def _search_block(docs: DataFrame, ids: list, pairs: list[tuple[int, bytes]], k: int) -> DataFrame:
    """The ranking for one block of items; ``pairs`` are (place in ``ids``, term)."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, t in pairs}))}
    postings = np.array(sorted((vocabulary[t], i) for i, t in pairs), np.int64).reshape(-1, 2)
    starts = np.searchsorted(postings[:, 0], np.arange(len(vocabulary) + 1))
    bags = _restricted(docs, vocabulary)
    seen = bags.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = _document_counts(bags, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * seen["docs"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    m = F.expr(f"CAST(100 - 50 + ((50 * n * {seen['docs']}L) DIV {max(1, seen['terms'])}L) AS BIGINT)")
    rows = bags.where(F.length("bag") > 0).select("id", m.alias("m"), "bag")
    rows = rows.withColumn("h", F.xxhash64("bag", "m"))
    same = Window.partitionBy("h", "m", "bag").orderBy(F.col("id").asc_nulls_last())
    rows = rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k)
    rows = rows.select("id", "m", "r", F.when(F.col("r") == 1, F.col("bag")).alias("bag"))
    best = mapped(rows, _scorer(ids, weights, starts, postings[:, 1].copy(), k), "item_id long, score long, first long, members array<long>")
    by_class = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "first")
    best = best.withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= k)
    best = best.select("item_id", "score", F.explode("members").alias("doc_id"))
    by_row = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = best.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score
    above 0 for each item, ties by ascending id."""
    spark = docs.sparkSession
    asked = _item_terms(items, item_col, item_text_col)
    blocks = max(1, -(-asked.count() // block_terms))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    found = []
    for block in range(blocks):
        rows = [(r["item"], bytes(r["term"])) for r in asked.where(F.col("block") == block).select("item", "term").collect()]
        if rows:
            ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
            place = {i: p for p, i in enumerate(ids)}
            found.append(_search_block(docs, ids, [(place[i], t) for i, t in rows], k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, found)
