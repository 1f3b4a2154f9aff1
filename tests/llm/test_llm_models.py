"""Classifier, language and decontamination: accuracy, brute force and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clicksieve.llm import decontamination, language_id, quality_classifier, queries
from samples import SF_SMALL, documents, no_documents, odd_documents, prose

SF = "/root/testdata/sf0.01"


def test_classifier_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = queries.op9_quality_classifier(spark, SF).collect()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.93
    good, bad = ([r["score"] for r in held if labels[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95


def test_dual_descent_reaches_the_optimum():
    """On a separable toy the hinge loss vanishes, and weights are the sum of support rows."""
    rows = [(np.array([i % 4]), np.array([1.0])) for i in range(40)]
    signs = np.array([1.0 if i % 4 < 2 else -1.0 for i in range(40)])
    weights = quality_classifier.coordinate_descent(rows, signs, np.full(40, 10.0))
    margins = signs * np.array([weights[b] @ v + weights[-1] for b, v in rows])
    assert (margins > 0.99).all()


def test_classifier_learns_from_labels_alone(spark):
    docs = documents(spark, [prose(60, i) if i % 2 else "BUY!! " * 60 for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None)], "doc_id long, quality int")
    kept = quality_classifier.keep_good(docs, labels)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(1, 80, 2))
    odd = odd_documents(spark)
    found = quality_classifier.classify(odd, labels).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in odd.collect())
    assert all(0 <= r["score"] <= 1 for r in found)
    assert quality_classifier.keep_good(odd, labels).columns == odd.columns
    assert quality_classifier.classify(no_documents(spark), labels).collect() == []
    for rows, score in ([], 0.5), ([(1, 1), (3, 1)], 0.8):
        model = quality_classifier.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert model.score("any text") == model.score(None) >= score - 0.1


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn_text(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    rest = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 and n_chars > 20")
    expected = {r["doc_id"]: r["lang"] for r in rest.collect()}
    found = language_id.identify(language_id.document_evidence(rest), model).collect()
    assert len(found) == len(expected)
    assert sum(expected[r["doc_id"]] == r["lang"] for r in found) / len(found) > 0.98


def test_language_query(spark):
    found = queries.op6_language_id(spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    pages = {r["page_id"]: re.search(r'lang="(\w+)"', r["html"])[1] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert Counter((r["doc_id"], r["page_id"]) for r in found) == Counter([(i, None) for i in docs] + [(None, i) for i in pages])
    right = [r["lang"] == (docs.get(r["doc_id"]) or pages.get(r["page_id"])) for r in found]
    assert sum(right) / len(right) > 0.97


def brute_fusion(rows, model):
    """The same fusion, row by row."""
    n, k = len(model.languages), language_id.PRIOR_ROWS
    logs = [model.likelihoods(r[2]) for r in rows]
    own = [np.exp(x) / np.exp(x).sum() for x in logs]
    whole = sum(own) + k / n
    overall = whole / whole.sum()
    out = []
    for a, r in enumerate(rows):
        def group(at):
            return [b for b, s in enumerate(rows) if s[at] == r[at]]

        found = np.array(logs[a])
        for at in (3, 4):
            if r[at] is not None:
                found += np.log((sum(own[b] for b in group(at)) - own[a] + k * overall) / (whole - own[a] + k))
        prior = overall
        for at in (5, 6):
            if r[at] is not None:
                prior = (sum(own[b] for b in group(at)) - own[a] + k * prior) / (len(group(at)) - 1 + k)
        found += np.log(prior)
        found = np.exp(found - found.max())
        out.append((model.languages[int(found.argmax())], float(found.max() / found.sum())))
    return out


def test_fusion_against_brute_force(spark):
    model = language_id.learn_text(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    draw = random.Random(4)
    texts = [None, "", "the and of", "der die das und", "le la les", "de la que", "xyz"]
    rows = [
        (i, None, draw.choice(texts), draw.choice([None, "en", "de"]), draw.choice([None, "com", "de"]), draw.choice([None, "a.com", "b.de"]), draw.choice([None, "x.a.com", "y.b.de", "z"]))
        for i in range(120)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, page_id long, text string, declared string, suffix string, domain string, host string")
    found = {r["doc_id"]: (r["lang"], r["probability"]) for r in language_id.identify(frame.repartition(3), model).collect()}
    for i, (lang, probability) in enumerate(brute_fusion(rows, model)):
        assert found[i][1] == pytest.approx(probability)
        assert found[i][0] == lang or probability < 0.5 + 1e-9


def test_language_of_odd_rows(spark):
    model = language_id.learn_text(odd_documents(spark))
    assert model.languages == ("en",)
    odd = odd_documents(spark)
    found = language_id.identify(language_id.document_evidence(odd), model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in odd.collect())
    none = language_id.learn_text(no_documents(spark))
    assert [tuple(r)[2:] for r in language_id.identify(language_id.document_evidence(odd.limit(1)), none).collect()] == [(None, None, None)]
    pages = spark.createDataFrame([(1, None, None), (None, "nonsense", "<html lang=>"), (3, "http://u@h.example.org:80/x", "<html data-lang='x' lang='DE'><p>und")], "page_id long, url string, html string")
    told = {r["page_id"]: (r["declared"], r["suffix"], r["domain"], r["host"]) for r in language_id.page_evidence(pages).collect()}
    assert told == {1: (None,) * 4, None: (None,) * 4, 3: ("de", "org", "example.org", "h.example.org")}
    assert language_id.identify(language_id.page_evidence(pages.limit(0)), model).collect() == []


def brute_tiles(item, doc, least):
    """Greedy string tiling by comparing everywhere."""
    item, doc, tiles = list(item), list(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and item[i + n] is not None:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        i, j, n = best
        if n < least:
            return tiles
        tiles.append(best)
        item[i : i + n], doc[j : j + n] = [None] * n, [None] * n


def test_tiles_against_brute_force():
    draw = random.Random(8)
    for _ in range(300):
        item = [draw.randrange(1, 5) for _ in range(draw.randint(1, 14))]
        doc = [draw.randrange(0, 5) for _ in range(draw.randint(0, 30))]
        least = draw.randint(1, 4)
        found = decontamination.tile(np.array(item, np.uint64), np.array(doc, np.uint64), least)
        assert found == brute_tiles(item, doc, least)


def benchmark_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_leaks_reordered_and_partial(spark):
    item = prose(40, 21)
    parts = [" ".join(item.split()[i : i + 10]) for i in range(0, 40, 10)]
    texts = [
        prose(100, 22) + " " + item.upper() + " " + prose(100, 23),
        f"{prose(80, 24)} {parts[2]} {prose(30, 25)} {parts[0]}. {parts[3]}\n{parts[1]}",
        prose(300, 26),
        f"{prose(100, 27)} {parts[1]}",
        None,
    ]
    benchmark = benchmark_frame(spark, [item, prose(30, 28), "", None, "two words"])
    found = {r["doc_id"]: r for r in decontamination.find_leaks(documents(spark, texts), benchmark).collect()}
    assert set(found) == {0, 1}
    assert found[0]["coverage"] == 1.0 and len(found[0]["tiles"]) == 1
    assert found[1]["covered"] >= 36 and len(found[1]["tiles"]) >= 4
    kept = decontamination.drop_leaks(documents(spark, texts), benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]


def test_leak_query_against_brute_force(spark):
    docs = {r["doc_id"]: decontamination.tokens(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: decontamination.tokens(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    expected = set()
    for i, doc in docs.items():
        fours = {tuple(doc[a : a + 4]) for a in range(len(doc) - 3)}
        for k, item in items.items():
            if sum(tuple(item[a : a + 4]) in fours for a in range(len(item) - 3)) * 4 >= 0.5 * len(item):
                if sum(t[2] for t in brute_tiles(item, doc, 4)) >= 0.5 * len(item):
                    expected.add((i, k))
    found = queries.op1_decontamination(spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected


def test_blocks_of_the_benchmark_give_one_result(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted((r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect())
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()) == whole


def test_leaks_of_odd_rows(spark):
    odd = odd_documents(spark)
    benchmark = benchmark_frame(spark, ["the same text in many rows, with a few more words to it", None, "a", "One!"])
    found = Counter(r["doc_id"] for r in decontamination.find_leaks(odd, benchmark).collect())
    assert found == {5: 3, 6: 1, 3: 1}
    assert decontamination.drop_leaks(odd, benchmark).columns == odd.columns
    assert decontamination.find_leaks(odd, benchmark.limit(0)).collect() == []
    assert decontamination.find_leaks(no_documents(spark), benchmark).collect() == []


def test_the_sample_stays_one_array_on_the_driver(spark, monkeypatch):
    rows = [(i, prose(30, i)) for i in range(8)] + [(3, None), (3, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    taken = []
    monkeypatch.setattr(quality_classifier, "train", lambda sets, good: taken.append((sets, good)))
    quality_classifier.learn(docs, labels)
    sets, good = taken[0]
    assert all(len(s) == 0 or np.shares_memory(s.base, sets[0].base) for s in sets)
    # By id, then label, then digest, rows without a text last.
    learned = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    digest = {t: (t is None, hashlib.sha256((t or "").encode()).hexdigest()) for _, t in learned}
    learned.sort(key=lambda row: (row[0], digest[row[1]]))
    assert [s.tolist() for s in sets] == [quality_classifier.ngrams(t).tolist() for _, t in learned]
    assert good.tolist() == [i % 2 == 1 for i, _ in learned]
