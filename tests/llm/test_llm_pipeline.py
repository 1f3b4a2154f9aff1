"""The pipeline against its stages worked out row by row."""

from collections import Counter

import corpus_pipeline
import pytest

from clicksieve.llm import decontamination, quality_classifier, secret_scan
from samples import SF_SMALL, no_documents, odd_documents
from test_llm_dedup import brute_components, brute_fingerprint
from test_llm_tokens import LIBRARY


def test_pipeline_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    model = quality_classifier.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if model.score(r["text"]) >= quality_classifier.KEPT_FROM}
    ids = sorted(texts)
    roots = brute_components([brute_fingerprint(texts[i]) for i in ids])
    first = [i for at, i in enumerate(ids) if roots[at] == at]
    block = decontamination.Block(items, decontamination.MIN_MATCH, decontamination.MIN_COVERAGE)
    kept = [i for i in first if not block.hits(texts[i])]
    assert 0 < len(kept) < len(first) < len(ids) < docs.count()
    expected = {i: LIBRARY.encode_ordinary(secret_scan.mask(texts[i]) or "") for i in kept}
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["ids"] for r in found} == expected and len(found) == len(kept)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in found)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows_in_every_stage(spark, name, stage):
    # The time of merges grows with the square of a word's length.
    docs = odd_documents(spark).where("text is null or text not like 'aaa%'")
    found = stage(spark, docs, SF_SMALL)
    rows, before = found.collect(), Counter(r["doc_id"] for r in docs.collect())
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert found.columns == docs.columns
    if name in ("secret_scan", "byte_level_bpe"):
        assert Counter(r["doc_id"] for r in rows) == before
    if name == "byte_level_bpe":
        assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    if name == "simhash_near_dedup":
        assert Counter(r["doc_id"] for r in rows)[5] == 1
    assert stage(spark, no_documents(spark), SF_SMALL).collect() == []


def test_empty_and_odd_tables_through_the_pipeline(spark, tmp_path):
    for name, docs in (("odd", odd_documents(spark).where("text is null or text not like 'aaa%'")), ("empty", no_documents(spark))):
        for table in ("labels", "benchmark"):
            rows = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
            (rows if name == "odd" else rows.limit(0)).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r["round_trip"] for r in found)
        assert name == "odd" or found == []
