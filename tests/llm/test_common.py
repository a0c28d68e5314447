"""Helpers that the operators share."""

import os

import pytest
from pyspark.sql import functions as F

from clientcurve.llm import _common as C
from clientcurve.llm import _tokens


@pytest.mark.parametrize("parts", [1, 4, 1000])
def test_join_hot_equals_a_join(spark, parts):
    rows = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)).alias("a"), (F.col("id") % 2).alias("b"), "id")
    table = rows.where("a <> 11").groupBy("a", "b").agg(F.count("*").alias("n"))
    want = sorted(map(tuple, rows.join(table, ["a", "b"]).collect()))
    assert sorted(map(tuple, C.join_hot(rows, table, ["a", "b"], "n", parts).collect())) == want
    assert C.join_hot(rows, table.where("a < 0"), ["a", "b"], "n", parts).count() == 0


def test_scratch_tables_go(spark):
    scratch = C.Scratch(spark)
    kept, gone = C.stored(spark.range(3), "kept"), C.stored(spark.range(4), "gone", scratch=scratch)
    assert gone.count() == 4 and len(scratch.paths) == 1
    place = scratch.paths[0].removeprefix("file:")
    assert os.path.isdir(place)
    scratch.remove()
    assert not os.path.exists(place) and kept.count() == 3 and not scratch.paths


@pytest.mark.parametrize("value,after", [("64m", C.BATCH_BYTES), ("67108864b", C.BATCH_BYTES), ("1000", "1000"), ("2m", "2m"), ("1g", C.BATCH_BYTES)])
def test_batches_are_bounded(spark, value, after):
    before = spark.conf.get(C._BATCH_KEY)
    try:
        spark.conf.set(C._BATCH_KEY, value)
        C.ship(spark)
        assert spark.conf.get(C._BATCH_KEY).rstrip("b") == str(after)
    finally:
        spark.conf.set(C._BATCH_KEY, before)


def test_long_texts_come_in_small_batches(spark):
    rows = spark.range(600).select("id", F.repeat(F.lit("x"), 100_000).alias("text")).coalesce(1)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    got = [r["n"] for r in C.mapped(rows, sizes, "n long").collect()]
    assert sum(got) == 600 and max(got) * 100_000 <= 2 * C.BATCH_BYTES


def test_other_tasks_drop_what_tokenizing_ones_cached():
    _tokens.encoder(_tokens.tokenizer_path("word_bpe_49k.json"))
    assert list(C.lean(lambda batches: (len(_tokens._encoders) for _ in batches), tokens=True)([1])) == [1]
    assert list(C.lean(lambda batches: (len(_tokens._encoders) for _ in batches))([1])) == [0]


def test_running_offsets_over_null_and_hot_groups(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, "hot").alias("g"), (F.col("id") % 5).alias("n"))
    want, sums = {}, {}
    for r in sorted(rows.collect(), key=lambda r: r["id"]):
        want[r["id"]] = sums.get(r["g"], 0)
        sums[r["g"]] = want[r["id"]] + r["n"]
    got = C.running_offsets(rows.repartition(7), ["g"], ["id"], "n", "before").collect()
    assert {r["id"]: r["before"] for r in got} == want
