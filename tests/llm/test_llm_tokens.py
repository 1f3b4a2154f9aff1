"""Byte-level BPE and token counts, against the libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicksieve.llm import byte_bpe, queries, token_counts
from samples import ODD_TEXTS, SF_SMALL, documents, no_documents, odd_documents

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def small_documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_bpe_query_against_the_library(spark):
    texts = small_documents(spark)
    found = queries.op3_byte_bpe(spark, SF_SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def random_texts():
    draw = random.Random(5)
    alphabet = "abetin AEs'0129.,!\n\t  éßñ中\U0001f600"
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 80))) for _ in range(150)] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 300]


def test_words_are_folded_in_a_plan_without_an_exchange(spark, monkeypatch):
    # With one, Spark describes the plan anew for each stage, all literals of the vocabulary spelled out.
    plans, frame = [], type(spark.range(0))
    collect = frame.toArrow
    monkeypatch.setattr(
        frame, "toArrow", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df)
    )
    words = spark.createDataFrame([("of",), ("of",), ("qzx",), ("qzx",), ("once",)], "word string")
    table = byte_bpe.dictionary(words, byte_bpe.Ranks(RANKS)).to_pylist()
    assert {r["word"]: r["ids"] for r in table} == {w: LIBRARY.encode_ordinary(w) for w in ("of", "qzx")}
    assert len(plans) == 1 and "Exchange" not in plans[0]


@pytest.mark.parametrize("most", [byte_bpe.DICTIONARY_WORDS, 20, 0])
def test_bpe_of_random_texts(spark, most):
    texts = random_texts() + random_texts()[:40]
    ranks = byte_bpe.Ranks(RANKS)
    coded = byte_bpe.encode(documents(spark, texts).repartition(3), ranks, P.PATTERN, most=most)
    for r in coded.withColumn("back", byte_bpe.decode(F.col("ids"), ranks)).collect():
        assert r["ids"] == LIBRARY.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["back"]).decode() == texts[r["doc_id"]]


def test_bpe_of_odd_rows(spark):
    ranks = byte_bpe.Ranks(RANKS)
    texts = [t if t is None or len(t) < 5000 or " " in t else t[:900] for t in ODD_TEXTS]  # one long word takes long
    found = byte_bpe.encode(documents(spark, texts), ranks, P.PATTERN).collect()
    assert {r["doc_id"]: r["ids"] for r in found} == {i: LIBRARY.encode_ordinary(t or "") for i, t in enumerate(texts)}
    rows = odd_documents(spark).where("length(text) < 5000 or text is null")
    assert byte_bpe.encode(rows, ranks, P.PATTERN).count() == rows.count()
    assert byte_bpe.encode(no_documents(spark), ranks, P.PATTERN).collect() == []
    decoded = spark.createDataFrame([(None,), ([],), ([50_000_000, 64],)], "ids array<int>")
    assert [r[0] for r in decoded.select(byte_bpe.decode(F.col("ids"), ranks)).collect()] == [None, b"", b"a"]


def test_count_query_against_the_library(spark):
    texts = small_documents(spark)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in queries.op7_token_counts(spark, SF_SMALL).collect():
        text = texts.pop(r["doc_id"]) or ""
        n = len(library.encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
    assert not texts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counters_agree_with_their_library(name):
    texts = [t or "" for t in ODD_TEXTS if len(t or "") < 5000] + random_texts() + ["a <|endoftext|>  b", " <|startoftext|>"]
    if name.endswith(".model"):
        import sentencepiece

        expected = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=P.path(name)).encode(texts)]
    else:
        library = Tokenizer.from_file(P.path(name))
        expected = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert token_counts.counter(P.path(name))(texts) == expected


def test_only_misses_are_encoded_and_appended(spark, tmp_path):
    cache, path = str(tmp_path / "cache"), P.path("byte_bpe_50k.json")
    first = documents(spark, ["a b", "a b", "c", None, ""])
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(first, path, cache).collect()} == {0: 2, 1: 2, 2: 1, 3: 0, 4: 0}
    assert spark.read.parquet(cache).count() == 3
    # A stored count is taken as it is.
    stored = spark.createDataFrame(
        [(token_counts.tokenizer_digest(path), hashlib.sha256(b"known").digest(), 77)], token_counts.CACHE_SCHEMA
    )
    stored.write.mode("append").parquet(cache)
    second = token_counts.count_tokens(documents(spark, ["known", "c", "new text"]), path, cache)
    assert {r["doc_id"]: r["n_tokens"] for r in second.collect()} == {0: 77, 1: 1, 2: 2}
    assert spark.read.parquet(cache).count() == 5
    # Another tokenizer shares nothing.
    token_counts.count_tokens(documents(spark, ["c"]), P.path("word_bpe_49k.json"), cache)
    assert spark.read.parquet(cache).count() == 6


def test_counts_of_odd_rows(spark, tmp_path):
    path = P.path("byte_bpe_50k.json")
    docs = odd_documents(spark)
    found = token_counts.count_tokens(docs, path, str(tmp_path / "cache")).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert all(r["n_tokens"] is not None for r in found)
    assert token_counts.count_tokens(no_documents(spark), path, str(tmp_path / "none")).collect() == []
