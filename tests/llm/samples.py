"""Odd rows that every operator has to get through, and small words."""

import random
import re

from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        T.StructField("fingerprint", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("shard", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("word", T.StringType()),
    ]
)


def prose(n_words, seed):
    draw = random.Random(seed)
    parts = "the of and ing tion er on re sta lo vi men quo ra de si".split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n_words))


ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "two words",
    "the same text in many rows, with a few more words to it",
    "the same text in many rows, with a few more words to it",
    "Ünï cödé \U0001f600 　 x́ \x1c\x85 ﻿ end",
    "a" * 70_000,
    prose(20_000, 1),
    'api_key = "q8Zx2LmN0pRtVw7yBc4D" and token: abcdefgh',
]


def odd_rows():
    rows = [(i, text, "en", "src0", len(text or "")) for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, None, None, None, None), (None, "no id", None, None, None), (None, "no id", None, None, None)]
    return [(*row, "f", 1, "s", "t", "u", "v", "w") for row in rows]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def documents(spark, texts, **columns):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
