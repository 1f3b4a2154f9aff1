"""From raw documents to token ids: five stages, each over all that the one before it kept.

Each stage is a function of (spark, docs, sf_dir). All but the last return the
columns of `documents`; what they return is written and read again.

Results in special cases: null, empty and white texts are scored like any other,
and of those that stay one stands for all, as they have one fingerprint; they
leak nothing, hold no secret and have no ids. Of repeated rows, of equal ids and
of ties one row stays in near_dedup, that of the smallest id, rows without an id
after the others; elsewhere each row is judged by itself. Very long texts are
taken whole. Empty tables give empty tables; without labels every document has
the same score. Columns beside doc_id and text pass through as they are, whatever
their names; n_chars, where it is there, is counted anew after masking.

Stages set Arrow batches to `BATCH_ROWS` rows for the session: Python workers
serve all stages in turn and keep the room that the largest batch took.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.llm import byte_bpe, decontamination, quality_classifier, secret_scan, simhash
from clicksieve.llm.common import read_table, utf8
from clicksieve.session import new_run_folder


# Rows that a Python worker is sent at once.
BATCH_ROWS = 1000


def small_batches(stage):
    """The stage, with Arrow batches of `BATCH_ROWS` rows."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"))


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return simhash.keep_first(docs)


@small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


@small_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.mask_secrets(docs)


@small_batches
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    ranks = byte_bpe.Ranks(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    whole = byte_bpe.decode(F.col("ids"), ranks) == utf8(F.coalesce("text", F.lit("")))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("byte_level_bpe", tokenize),
]

# Training, tokenizing and hashing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    folder = new_run_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
