"""Rows that share a doc_id but not a text."""

from clicksieve.llm import quality_classifier, simhash
from samples import prose


def test_every_component_keeps_one_row(spark):
    texts = [prose(80, seed) for seed in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[1]), (2, texts[2]), (1, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], texts.index(r["text"])) for r in simhash.keep_first(docs).collect())
    assert kept == [(1, 0), (1, 1), (1, 3), (2, 2)]


def test_copies_neither_reach_the_driver_nor_weigh_more(spark, monkeypatch):
    rows = [(i, prose(30, i)) for i in range(10)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(quality_classifier, "train", lambda ngrams, good: taken.append((len(ngrams), good.tolist())))
    for docs in (rows, rows + [rows[0], rows[1]] * 200):
        quality_classifier.learn(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), labels)
    assert taken[0] == taken[1] and taken[0][0] <= 10
