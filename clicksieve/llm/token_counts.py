"""Token counts kept in a cache of digests.

A text is known by the SHA-256 of its normalised form, and a tokenizer by the
SHA-256 of its file. Texts whose pair of digests is in the cache take the
stored count; of the others each different text is encoded once and appended.

Normalised means: null is the empty text, and text is taken as UTF-8. Nothing
else is folded together, as any other change may change the count.

Results in special cases: null and empty texts have no tokens; repeated rows
and equal texts are encoded once and each gets its row; an empty table gives an
empty one and appends nothing; a cache that holds a pair twice counts as if it
held it once; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.llm.common import keyed_text, utf8
from clicksieve.session import shared_folder

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("tokenizer", T.BinaryType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
# Words whose counts a worker remembers, some 100 MB of them; further ones it
# encodes where they occur and forgets.
REMEMBERED_WORDS = 600_000
# Characters of texts that are counted together.
TOGETHER = 1 << 20
# What byte-level tokenizers split texts by before merging (fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_digest(path: str) -> bytes:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).digest()


def _splits_into_words(spec: dict) -> bool:
    """Is this a byte-level BPE that merges each match of the pattern on its own?"""
    splitter = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and spec["model"].get("type") in ("BPE", None)
        and not spec["model"].get("dropout")
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space", True)
    )


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts as the library of that file does."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]

    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    spec = json.loads(tokenizer.to_str())
    if not _splits_into_words(spec):
        return whole
    added = [token["content"] for token in spec.get("added_tokens", [])]
    holds_added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
    find = regex.compile(BYTE_LEVEL_PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    known: dict[str, int] = {}

    def together(texts: list[str]) -> list[int]:
        split = [find(text) for text in texts]
        new = list(set().union(*split) - known.keys())
        known.update(zip(new, whole(new), strict=True))
        counts = [sum(map(known.__getitem__, words)) for words in split]
        if len(known) > REMEMBERED_WORDS:
            for word in new:
                del known[word]
        return counts

    def by_words(texts: list[str]) -> list[int]:
        """The tokens of a text are those of its words; only new words are encoded."""
        counts, part, size = [], [], 0
        for text in texts:
            if holds_added.search(text):
                counts += [*together(part), *whole([text])]
                part, size = [], 0
                continue
            part.append(text)
            size += len(text)
            if size > TOGETHER:
                counts += together(part)
                part, size = [], 0
        return counts + together(part)

    return by_words


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """digest, text -> digest, n_tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for batch in batches:
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": count(batch["text"].tolist())})

    return texts.select("digest", "text").mapInPandas(run, "digest binary, n_tokens long")


def read_cache(spark: SparkSession, cache: str, tokenizer: bytes) -> DataFrame:
    """digest and count of what is stored for a tokenizer; nothing where there is no cache yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA).select("digest", "n_tokens")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == F.lit(tokenizer))
    # Grouped by another name of the digest: a later join on the digest then has
    # an exchange of its own, of which Spark splits what a hot text fills.
    named = stored.groupBy(F.hex("digest").alias("name")).agg(F.max("n_tokens").alias("n_tokens"))
    return named.select(F.unhex("name").alias("digest"), "n_tokens")


def default_cache(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/token-counts"


def count_tokens(
    docs: DataFrame, path: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens. Appends what was missing to the cache first."""
    spark = docs.sparkSession
    cache = cache or default_cache(spark)
    tokenizer = tokenizer_digest(path)
    digested = keyed_text(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2(utf8(F.col("text")), 256)))
    # Equal texts meet after every task has reduced its own to one.
    misses = (
        digested.select("digest", "text")
        .join(read_cache(spark, cache, tokenizer).select("digest"), "digest", "left_anti")
        .dropDuplicates(["digest"])
    )
    found = encode_counts(misses, path)
    found.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, tokenizer)
    sized = digested.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(counts, "digest", "left").select("doc_id", "n_bytes", "n_tokens")
