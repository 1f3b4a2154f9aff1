"""The registered queries: each operator over its whole table, with the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.llm import (
    byte_bpe,
    decontamination,
    html_extraction,
    hard_negatives,
    language_id,
    line_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    source_audit,
    token_counts,
)
from clicksieve.llm.common import read_table, utf8
from clicksieve.llm.sql import oracle_sql  # noqa: F401 - queries() and oracle_sql() are taken from here
from clicksieve.session import new_run_folder

# Texts longer than this many tokens are marked.
TOKEN_LIMIT = 1024


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(read_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.Ranks(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by all their evidence, and documents by text and source."""
    documents = read_table(spark, sf_dir, "documents")
    model = language_id.learn_text(documents)
    pages = language_id.identify(language_id.page_evidence(read_table(spark, sf_dir, "pages")), model)
    return pages.unionByName(language_id.identify(language_id.document_evidence(documents), model))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    # A cache of its own: every text of the table is a miss the first time.
    counted = token_counts.count_tokens(
        read_table(spark, sf_dir, "documents"), path, new_run_folder(spark, "token-counts")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(read_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.extract_pages(read_table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    # Fixed rule: every seventh row changes its label.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    relabelled = rows.withColumn("label", label)
    return hard_negatives.mine(relabelled, "vec_id", "embedding", "label", is_anchor=F.col("vec_id") % 100 == 0)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(utf8(F.col("text")), 256).alias("kept_sha256"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_simhash": op2_simhash,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_sharding": op4_sharding,
        "op5_secret_scan": op5_secret_scan,
        "op6_language_id": op6_language_id,
        "op7_token_counts": op7_token_counts,
        "op8_quality_rules": op8_quality_rules,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_html_extraction": op10_html_extraction,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_line_dedup": op12_line_dedup,
        "op13_source_audit": op13_source_audit,
    }
