"""The registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clientcurve.session import ensure_checkpoint_dir, shared_path

from . import oracle
from ._common import ship
from ._tokens import tokenizer_path
from .hard_negatives import hard_negatives
from .html_extract import extract_articles
from .lexical_bags import ranked_search
from .mixing import mix_sources
from .ngram_jaccard import ngram_jaccard
from .packing import pack_documents
from .preference import one_row_a_turn, preference_segments, swapped_endings
from .quality_cnn import fitted, quality_scores
from .suffix_dedup import suffix_dedup
from .token_codes import read_codes, write_codes
from .topk_nra import exact_topk
from .vp_tree import nearest_neighbours
from .warc_bundles import read_archives, write_archives


END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five largest inner products of every fiftieth vector with all others."""
    return exact_topk(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op2_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest by cosine of every fiftieth vector among all others."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as directly addressable codes and
    read back from the files."""
    path = shared_path(spark, "token-codes")
    write_codes(_table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=END_ID)
    return read_codes(spark, path)


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of each conversation (chosen) against itself
    with its neighbour's last turn (rejected)."""
    turns = one_row_a_turn(_table(spark, sf_dir, "conversations"), "conv_id")
    return preference_segments(turns, swapped_endings(turns)).withColumnRenamed("pair", "pair_id")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share 90 of 100 distinct 3-word shingles."""
    return ngram_jaccard(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text without strings of 400 bytes that repeat, and how
    many bytes repeated passages of 200 bytes cover (those of over 50 usual words)."""
    return suffix_dedup(_table(spark, sf_dir, "documents"), length=400, passage=corpus_pipeline.REPEAT_BYTES)


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a text's quality label is 1, from its bytes alone."""
    docs = _table(spark, sf_dir, "documents")
    return quality_scores(docs, fitted(docs, _table(spark, sf_dir, "labels")))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources to weights 5, 2, 1 takes of each document."""
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the path its host's pages vote for."""
    return extract_articles(_table(spark, sf_dir, "pages"))


def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4,096 tokens that mix the sources."""
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=END_ID)


def op11_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of every page, written to seekable bundles and read back from them."""
    path = shared_path(spark, "warc-bundles")
    write_archives(_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_lexical_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty best documents of each benchmark item, by lexical score."""
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, applied to documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_exact_topk, op2_vp_tree, op3_token_codes, op4_preference, op5_ngram_jaccard, op6_suffix_dedup, op7_quality_cnn, op8_mix_sources, op9_html_extract, op10_pack_documents, op11_warc_bundles, op12_lexical_bags, op13_hard_negatives, pipeline)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run

    return {name: wrap(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    own = dict(oracle.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
