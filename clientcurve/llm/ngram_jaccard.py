"""N-gram Jaccard join (operator 5).

Documents are sets of word n-grams. Two documents link when
``den * |A and B| >= num * |A or B|``. The join is a blocked sparse matrix
product of the document by n-gram incidence matrix with its transpose:

1. *Sets.* One vectorised pass turns whole texts into sets of 64-bit n-gram
   hashes. Equal sets get one 128-bit key; from here on a set of any number of
   copies is one row. The same pass counts every n-gram into a fixed number of
   hash buckets.
2. *Size bound before the product.* In any one order of all n-grams, a linked
   pair must share one of the first ``n - ceil(n*num/den) + 1`` n-grams of each
   set. The order is (bucket count, hash), so that frequent n-grams stand last
   and their columns are not touched. Sets in the column of such an n-gram are
   tied together where their sizes and sketches allow a link: only sets of
   near sizes meet, in overlapping size classes; a sketch has the parity of the
   set in each of 1,024 or more hash buckets, and two sketches differ in at most
   as many bits as the sets in members. Ties are contracted to candidate
   groups.
3. *Blocks.* A candidate group is ordered by set size and cut into blocks of a
   bounded number of n-grams; only pairs of blocks whose size ranges can reach
   the threshold meet. A group of three blocks or more is contracted first: each of
   its sets meets a few representatives, and blocks are then cut from what hangs
   together by these verified links, and need not meet within it. In a task, overlap counts are accumulated row by row
   over the shared columns, and counts below the bound
   ``num * (a + b) / (num + den)`` are discarded. A task returns a spanning
   forest of its links, never its pairs.
4. Components of the forests give the classes.

No pair of sets that links is lost: steps 2 and 3 only skip pairs which the
sizes or the order rule out, and the counts are exact (up to 64-bit hashes of
n-grams and 128-bit keys of sets).

Defined cases: null or empty texts have the empty set, link with nothing and
form their own class, even if repeated. A null id stands for itself: the row
gets the smallest non-null id of its class, or null. Repeated rows share a
class; an id that repeats with other texts is several documents of that id.
Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch, join_hot, mapped, pinned, running_offsets, sorted_groups, stored, text_slices
from ._graph import connected_components
from ._hashing import PrefixHash, mix

SLICE_BYTES = 2 << 20
HISTOGRAM_BITS = 20  # buckets of the n-gram counts: a table of 4 MB
CHUNK_BITS = 14
SKETCH_BITS = 1024  # at least; more for large sets, see sketch()
COLUMN_ROWS = 2048  # longer columns tie all their rows, which only widens a group
BLOCK_NGRAMS = 1 << 19  # n-grams of one block: 4 MB of hashes
REPRESENTATIVES = 16

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True


def ngram_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each document of a slice.
    A document of fewer than n words has its whole word sequence as one."""
    docs = len(offsets) - 1
    if not len(data):
        return [np.zeros(0, np.uint64)] * docs
    low = _lower[data]
    word = ~_space[low]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = word[firsts]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    lasts = offsets[1:] - 1
    lasts = lasts[lasts >= 0]
    ends[lasts] = word[lasts]
    starts = np.flatnonzero(begins)
    h = mix(PrefixHash(low).at(starts, np.flatnonzero(ends) + 1))
    first_word = np.searchsorted(starts, offsets)
    grams = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        grams = (grams + h[i : i + len(grams)]) * np.uint64(0x9FB21C651E98DF25)
        grams ^= grams >> np.uint64(28)
    grams = mix(grams)
    out = []
    for d in range(docs):
        a, b = first_word[d], first_word[d + 1]
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for x in h[a:b]:
                short = (short ^ x) * np.uint64(0xA24BAED4963EE407)
            out.append(mix(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(grams: np.ndarray) -> bytes | None:
    """128-bit key of a set; None for the empty one."""
    if not len(grams):
        return None
    both = np.array([grams.sum(), np.bitwise_xor.reduce(mix(grams ^ np.uint64(0x5851F42D4C957F2D)))], np.uint64)
    return mix(both + np.uint64(len(grams))).tobytes()


def sketch(grams: np.ndarray, num: int, den: int) -> bytes:
    """Parity of a set in each bucket. Unrelated sets differ in nearly half the
    buckets; for that to exceed what a link allows, (a + b) * (den - num) /
    (den + num) bits, the buckets grow with the set: a power of two."""
    need = -(-5 * len(grams) * (den - num) // (den + num))
    bits = max(SKETCH_BITS, 1 << max(0, need - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _stacked(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, longer ones folded to the shortest."""
    least = min(map(len, sketches))
    rows = []
    for s in sketches:
        bits = np.frombuffer(s, np.uint64)
        while len(bits) * 8 > least:
            half = len(bits) // 2
            bits = bits[:half] ^ bits[half:]
        rows.append(bits)
    return np.stack(rows)


def _short(key: bytes) -> int:
    """The first half of a key; sets that share it by chance only share a candidate group."""
    return int(np.frombuffer(key[:8], np.int64)[0])


def _prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-size * num // den) + 1


def _sets_and_counts(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Rows of kind 0: one for each document; of kind 1: bucket counts of a task."""
    id_type = docs.schema["__id"].dataType.simpleString()
    schema = f"kind int, __id {id_type}, n long, key binary, k long, sketch binary, text_hash long, chunk int, counts binary"

    def run(batches):
        ids_type, counts = None, np.zeros(1 << HISTOGRAM_BITS, np.uint32)
        for batch in batches:
            ids = batch.column(0)
            ids_type = ids.type
            hashes = batch.column(2)
            for lo, size, data, off in text_slices(batch, "__text", SLICE_BYTES):
                sets = ngram_hashes(data, off, n)
                buckets = np.concatenate(sets) >> np.uint64(64 - HISTOGRAM_BITS)
                counts += np.bincount(buckets.astype(np.int64), minlength=len(counts)).astype(np.uint32)
                keys = [set_key(s) for s in sets]
                yield _rows(
                    schema_names,
                    [np.zeros(size, np.int32), ids.slice(lo, size), [len(s) for s in sets], keys, [None if k is None else _short(k) for k in keys], [sketch(s, num, den) for s in sets], hashes.slice(lo, size), [None] * size, [None] * size],
                    ids_type,
                )
        if ids_type is not None:
            parts = counts.reshape(-1, 1 << CHUNK_BITS)
            k = [i for i in range(len(parts)) if parts[i].any()]
            yield _rows(schema_names, [np.ones(len(k), np.int32), *[[None] * len(k)] * 6, k, [zlib.compress(parts[i].tobytes(), 1) for i in k]], ids_type)

    schema_names = ["kind", "__id", "n", "key", "k", "sketch", "text_hash", "chunk", "counts"]
    return mapped(docs, run, schema)


def _rows(names, columns, ids_type) -> pa.RecordBatch:
    types = [pa.int32(), ids_type, pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _total_counts(table: DataFrame) -> np.ndarray:
    """The bucket counts of all tasks: a table of fixed size, 4 MB."""

    def add(key, pdf):
        import pandas as pd

        total = np.zeros(1 << CHUNK_BITS, np.uint64)
        for c in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(c), np.uint32)
        top = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pd.DataFrame({"chunk": [key[0]], "counts": [top.tobytes()]})

    chunks = table.where("kind = 1").select("chunk", "counts")
    out = np.zeros(1 << HISTOGRAM_BITS, np.uint32)
    for row in chunks.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        out[row["chunk"] << CHUNK_BITS : (row["chunk"] + 1) << CHUNK_BITS] = np.frombuffer(row["counts"], np.uint32)
    return out


def _postings(docs: DataFrame, n: int, num: int, den: int, counts) -> DataFrame:
    """(gram, set) for the n-grams of each set's prefix."""

    def run(batches):
        order = counts.value
        for batch in batches:
            for _, _, data, off in text_slices(batch, "__text", SLICE_BYTES):
                grams, owners = [], []
                for s in ngram_hashes(data, off, n):
                    if len(s):
                        rare = order[(s >> np.uint64(64 - HISTOGRAM_BITS)).astype(np.int64)]
                        p = _prefix_length(len(s), num, den)
                        first = s[np.argsort(rare, kind="stable")[:p]]  # s is sorted: ties go by hash
                        grams.append(first)
                        owners.append(np.full(p, _short(set_key(s))))
                if grams:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(owners))], names=["gram", "k"])

    return mapped(docs.select("__text"), run, "gram long, k long")


def _ties(columns: DataFrame, num: int, den: int) -> DataFrame:
    """Spanning forests (a, b) of the pairs in each column of prefix n-grams
    that sizes and sketches admit."""

    def run(batches):
        a, b, held = [], [], 0
        for g in sorted_groups(batches, ["gram", "class"]):
            if g.num_rows < 2:
                continue
            k, n = g.column("k").to_numpy(), g.column("n").to_numpy()
            m = len(k)
            bits = _stacked(g.column("sketch").to_pylist())
            root = np.arange(m)
            for i in range(1, m):
                differ = np.bitwise_count(bits[:i] ^ bits[i]).sum(axis=1, dtype=np.int64)
                ok = (differ * (num + den) <= (n[:i] + n[i]) * (den - num)) & (np.minimum(n[:i], n[i]) * den >= np.maximum(n[:i], n[i]) * num)
                _join_rows(root, i, np.flatnonzero(ok))
            some = np.flatnonzero(root != np.arange(m))
            a.append(k[some])
            b.append(k[root[some]])
            held += len(some)
            if held > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a, b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return mapped(columns, run, "a long, b long")


def _join_rows(label: np.ndarray, i: int, hit: np.ndarray) -> None:
    """Join row i with the components of the rows ``hit`` before it."""
    if len(hit):
        roots = np.unique(label[hit])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
        label[i] = roots[0]


def _links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Spanning forests (a, b) of the links in each pair of blocks."""

    def run(batches):
        a, b = [], []
        for g in sorted_groups(batches, ["grp", "i", "j"]):
            if g.num_rows < 2:
                continue
            keys = g.column("key").to_pylist()
            blk = g.column("blk").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in g.column("grams").to_pylist()]
            seen: dict[bytes, int] = {}  # a repeated row may bring a set twice; a representative stands for itself
            for x in np.argsort(blk, kind="stable").tolist():
                seen.setdefault(keys[x], x)
            pick = sorted(seen.values(), key=lambda x: (len(sets[x]), keys[x]))
            keys, blk, sets = [keys[x] for x in pick], blk[pick], [sets[x] for x in pick]
            same = g.column("i")[0].as_py() == g.column("j")[0].as_py()
            root = _overlap_forest(sets, None if same else blk, num, den)
            some = [x for x, r in enumerate(root) if r != x]
            a += [keys[x] for x in some]
            b += [keys[root[x]] for x in some]
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return mapped(rows, run, "a binary, b binary")


def _overlap_forest(sets: list[np.ndarray], side: np.ndarray | None, num: int, den: int) -> np.ndarray:
    """Component root of each row: row i of the product is accumulated over the
    columns of set i, for the rows before it that its size admits. With
    ``side``, only rows of the other side meet."""
    m = len(sets)
    label = np.arange(m)
    if m < 2:
        return label
    size = np.array([len(s) for s in sets])
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), size)
    by_col = np.argsort(col, kind="stable")
    docs_of = row[by_col]  # rows of each column, ascending
    end = np.cumsum(np.bincount(col))
    start = end - np.bincount(col)
    rank = np.empty(len(col), np.int64)
    rank[by_col] = np.arange(len(col)) - start[col[by_col]]
    at = np.concatenate([[0], np.cumsum(size)])
    for i in range(1, m):
        cols = col[at[i] : at[i + 1]]
        before = rank[at[i] : at[i + 1]]  # rows of the column that stand before i
        some = before > 0
        if not some.any():
            continue
        lens = before[some]
        idx = np.arange(lens.sum()) + np.repeat(start[cols[some]] - (np.cumsum(lens) - lens), lens)
        overlap = np.bincount(docs_of[idx], minlength=i)[:i]
        ok = overlap * (num + den) >= num * (size[:i] + size[i])
        if side is not None:
            ok &= side[:i] != side[i]
        _join_rows(label, i, np.flatnonzero(ok))
    return label


def _blocked(members: DataFrame) -> DataFrame:
    """``members(key, n, grp, rep, sub)`` with ``blk``: each part of a group, in order of
    size, cut into blocks. A running sum numbers them, which spreads a group of any
    size over many tasks."""
    at = running_offsets(members, ["grp", "sub"], ["n", "key"], "n", "before")
    return at.withColumn("blk", F.floor(F.col("before") / BLOCK_NGRAMS).cast("int")).drop("before")


def _block_numbers(members: DataFrame) -> DataFrame:
    """``(grp, sub, blk, lo, hi, no)``: sizes in each block, and its number in its
    group. A row a block."""
    ranges = members.groupBy("grp", "sub", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    return ranges.withColumn("no", F.row_number().over(Window.partitionBy("grp").orderBy("sub", "blk")) - 1)


def _block_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """``(grp, no, i, j)``: for each pair (i, j) of blocks that have to meet, both of
    its blocks. Blocks of one part of a group, whose sets are linked already, do not
    meet, nor do those whose sizes rule links out."""
    blocks = _block_numbers(members)
    x, y = blocks.alias("x"), blocks.alias("y")
    sizes = (F.col("y.lo") * num <= F.col("x.hi") * den) & (F.col("x.lo") * num <= F.col("y.hi") * den)
    apart = F.col("x.sub").isNull() | ~F.col("x.sub").eqNullSafe(F.col("y.sub"))
    meet = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.no") <= F.col("y.no")) & sizes & apart)
    meet = meet.select(F.col("x.grp").alias("grp"), F.col("x.no").alias("i"), F.col("y.no").alias("j"))
    return meet.select("grp", F.col("i").alias("no"), "i", "j").union(meet.where("i < j").select("grp", F.col("j").alias("no"), "i", "j"))


def _representatives(base: DataFrame, members: DataFrame, n: int, num: int, den: int, parts: int) -> DataFrame | None:
    """Verified links (a, b) of the sets of large groups with a few sets of their
    group, chosen by hash; None if no group has three blocks. What hangs together by
    these links need not be paired any more, so that a class of near copies of any
    size takes work in proportion to it."""
    large = members.groupBy("grp").agg(F.max("blk").alias("last"), F.count("*").alias("rows")).where("last >= 2")
    large = pinned(large)
    if large.isEmpty():
        return None
    mine = join_hot(members.select("key", "n", "grp", "blk", "rep"), large, ["grp"], "rows", parts)
    some = mine.where(F.col("n") <= BLOCK_NGRAMS // REPRESENTATIVES).withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("key"), "key")))
    some = some.where(F.col("r") <= REPRESENTATIVES)
    all_blocks = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.struct(i.alias("i"), F.lit(-1).alias("j")))
    own_block = F.array(F.struct(F.col("blk").alias("i"), F.lit(-1).alias("j")))
    wanted = some.select("key", "grp", F.lit(-1).alias("blk"), all_blocks.alias("pairs"), "rep").unionByName(mine.select("key", "grp", "blk", own_block.alias("pairs"), "rep"))
    return stored(_links(_meeting_sets(base, wanted, n, parts), num, den), "ngram-representatives")


def _meeting_sets(base: DataFrame, wanted: DataFrame, n: int, parts: int) -> DataFrame:
    """``(key, grp, blk, grams, i, j)`` by pair of blocks: the sets of ``wanted(key, grp,
    blk, pairs, rep)``, made again from the text of one document each."""
    asked = wanted.select("key", "grp", "blk", "pairs", F.col("rep.__id").alias("r_id"), F.col("rep.text_hash").alias("r_hash"))
    found = base.join(asked, F.col("__id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")))

    def grams_of(batches):
        for batch in batches:
            for lo, size, data, off in text_slices(batch, "__text", SLICE_BYTES):
                part = batch.slice(lo, size)
                sets = ngram_hashes(data, off, n)
                keys = part.column(0).to_pylist()
                right = [d for d, s in enumerate(sets) if set_key(s) == keys[d]]
                take = pa.array(right, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(take) for c in range(4)] + [pa.array([sets[d].tobytes() for d in right], pa.binary())],
                    names=["key", "grp", "blk", "pairs", "grams"],
                )

    got = mapped(found.select("key", "grp", "blk", "pairs", "__text"), grams_of, "key binary, grp long, blk int, pairs array<struct<i:int,j:int>>, grams binary")
    sets = got.select("key", "grp", "blk", "grams", F.inline("pairs"))
    return sets.repartition(parts, "grp", "i", "j").sortWithinPartitions("grp", "i", "j")


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(<id_col>, n_shingles, component_id)`` for every row of ``docs``:
    classes of documents whose n-gram sets reach Jaccard ``num/den``."""
    rows = jaccard_rows(docs, id_col, text_col, n, num, den)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def jaccard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(id, text_hash, n, component_id, first)`` for every row of ``docs``;
    ``first``: whether id and text are those of its class's document of smallest
    id (null last), then text hash."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    table = stored(_sets_and_counts(base, n, num, den), "ngram-sets")
    counts = spark.sparkContext.broadcast(_total_counts(table))
    rows = table.where("kind = 0").select("__id", "n", "key", "k", "sketch", "text_hash")

    # Candidate groups: sets tied by a shared n-gram of their prefixes.
    scratch = Scratch(spark)
    postings = stored(_postings(base, n, num, den, counts), "ngram-postings", scratch=scratch)
    shared = postings.groupBy("gram").agg(F.min("k").alias("a"), F.max("k").alias("z")).where("a < z")
    sketches = rows.where("n > 0").groupBy("k").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    common = postings.join(shared.select("gram"), "gram").distinct().join(sketches.select("k", "n"), "k")
    # A size stands in two classes, each den/num wide: sizes that may link meet in one of them.
    grade = F.floor(F.log(F.col("n")) / math.log(den / num * (1 + 1e-9))).cast("int") if num < den else F.col("n").cast("int")
    common = stored(common.select("gram", "k", "n", F.explode(F.array(grade, grade + 1) if num < den else F.array(grade)).alias("class")), "ngram-common", scratch=scratch)
    near = pinned(common.groupBy("gram", "class").agg(F.count("*").alias("rows")).where("rows > 1"))
    short = near.where(F.col("rows") <= COLUMN_ROWS).select("gram", "class")
    columns = common.join(short, ["gram", "class"]).join(sketches.select("k", "sketch"), "k")
    ties = _ties(columns.repartition(parts, "gram", "class").sortWithinPartitions("gram", "class", "n", "k"), num, den)
    # A longer column is no task's work: its sets are all tied to the least of them.
    long = join_hot(common, near.where(F.col("rows") > COLUMN_ROWS), ["gram", "class"], "rows", parts, scratch)
    least = long.groupBy("gram", "class").agg(F.min("k").alias("b"), F.first("rows").alias("rows"))
    long = join_hot(long.drop("rows"), least, ["gram", "class"], "rows", parts, scratch).where("k <> b").select(F.col("k").alias("a"), "b")
    ties = ties.unionByName(long)
    groups = connected_components(ties).select(F.col("node").alias("k"), F.col("label").alias("grp"))
    scratch.remove()

    # One row for each distinct set; those of candidate groups are cut into blocks.
    classes = rows.where("n > 0").groupBy("key", "k", "n").agg(
        F.min("__id").alias("first_id"), F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "text_hash")).alias("rep")
    )
    classes = stored(classes, "ngram-classes")
    members = pinned(_blocked(classes.join(groups, "k").select("key", "n", "grp", "rep", F.lit(None).cast("binary").alias("sub"))))
    known = _representatives(base, members, n, num, den, parts)
    if known is not None:
        parted = connected_components(known).select(F.col("node").alias("key"), F.col("label").alias("sub"))
        members = pinned(_blocked(members.drop("sub", "blk").join(parted, "key", "left").select("key", "n", "grp", "rep", "sub")))
    both = _block_pairs(members, num, den)
    places = both.groupBy("grp", "no").agg(F.collect_list(F.struct("i", "j")).alias("pairs"))
    numbered = members.join(_block_numbers(members).select("grp", "sub", "blk", "no").withColumnsRenamed({"grp": "g", "sub": "s", "blk": "b"}), (F.col("grp") == F.col("g")) & F.col("sub").eqNullSafe(F.col("s")) & (F.col("blk") == F.col("b")))
    wanted = numbered.select("key", "rep", "grp", "no").join(places, ["grp", "no"]).select("key", "grp", F.col("no").alias("blk"), "pairs", "rep")
    forest = _links(_meeting_sets(base, wanted, n, parts), num, den)
    if known is not None:
        forest = forest.unionByName(known)
    labels = connected_components(forest).withColumnRenamed("node", "key")

    named = classes.select("key", "first_id", "rep").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"), F.min("rep").alias("kept"))
    by_key = named.select("key", "label").join(smallest, "label").select("key", "component_id", "kept")
    return rows.join(by_key, "key", "left").select(
        F.col("__id").alias("id"),
        "text_hash",
        "n",
        F.when(F.col("n") == 0, F.col("__id")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("__id").eqNullSafe(F.col("kept.__id")) & (F.col("text_hash") == F.col("kept.text_hash")))).alias("first"),
    )

