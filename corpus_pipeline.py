"""A corpus pipeline: five stages, each over all that the one before it kept.

1. quality classifier: documents that it rejects go;
2. n-gram Jaccard join: of each class of near copies (five words, similarity 0.8)
   one row stays, that of the smallest id (null last, then by text hash);
3. suffix-array dedup: strings of ``REPEAT_BYTES`` that occur elsewhere are cut out
   of the texts. The length is in bytes, not words: a passage of 51 words reaches
   it if they average 3.94 bytes with their space. At sf0.1, 18,985 of 3,528,163
   stretches of 51 words (0.54 %, in 166 of 10,000 documents) are shorter, the
   shortest 101 bytes; a repeat of these alone stays;
4. mixing sources to target weights: documents are left out or repeated;
5. packing: pieces of the documents in sequences of 4,096 tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, all but the
last with the columns of ``documents``. ``run`` stores each stage's rows as
Parquet in the shared folder and rereads them.

Defined cases: stage 2 tells rows apart by id and text, null ids included, and of
rows equal in both one stays; null and empty texts pass all
stages that their score passes; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientcurve.llm._common import ship, stored
from clientcurve.llm._tokens import tokenizer_path
from clientcurve.llm.mixing import mixed
from clientcurve.llm.ngram_jaccard import jaccard_rows
from clientcurve.llm.packing import pack_documents
from clientcurve.llm.quality_cnn import THRESHOLD, fitted, scorer
from clientcurve.llm.suffix_dedup import without_repeats
from clientcurve.session import ensure_checkpoint_dir

REPEAT_BYTES = 200
END_ID = 2

ORACLE_SQL = None  # no SQL for a network, suffix sort or tokenizer; tests hold it against brute force


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    _ready(spark)
    net = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(scorer(net)(F.col("text")) >= THRESHOLD)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies."""
    _ready(spark)
    found = stored(jaccard_rows(docs, n=5, num=80, den=100).where("n > 0").select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "first"), "pipeline-classes")
    again = found.where("first").groupBy("__id", "__hash").agg(F.count("*").alias("rows")).where("rows > 1").select("__id", "__hash")
    gone = found.where("NOT first").select("__id", "__hash").distinct().union(again)
    # The columns of documents, whatever their names, travel as one.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col("doc_id").alias("__own_id"), F.xxhash64("text").alias("__own_hash"))
    same = F.col("__own_id").eqNullSafe(F.col("__id")) & (F.col("__own_hash") == F.col("__hash"))
    one = rows.join(again, same).dropDuplicates(["__own_id", "__own_hash"])
    return rows.join(gone, same, "left_anti").select("__doc.*").union(one.select("__doc.*"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that repeat."""
    _ready(spark)
    cut = without_repeats(docs, length=REPEAT_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    _ready(spark)
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    _ready(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=END_ID)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeats),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from ``documents``."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i + 1}")
    return docs
