"""Quality rules, secrets, sharding and pages against brute force."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from clicksieve.llm import html_extraction, quality_rules, queries, secret_scan, sharding
from samples import SF_SMALL, documents, no_documents, odd_documents, prose, words


def table(spark, name, key, value):
    return {r[key]: r[value] for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()}


def brute_base(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def brute_share(text, n):
    """The share of characters in n-grams that were there before."""
    found = words(text)
    seen, covered = set(), set()
    for i in range(len(found) - n + 1):
        if tuple(found[i : i + n]) in seen:
            covered.update(range(i, i + n))
        seen.add(tuple(found[i : i + n]))
    return sum(len(found[i]) for i in covered) / max(sum(map(len, found)), 1)


def test_quality_rules_query(spark):
    texts = table(spark, "documents", "doc_id", "text")
    found = queries.op8_quality_rules(spark, SF_SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]]
        base = brute_base(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        share = max(brute_share(text, n) for n in quality_rules.LENGTHS)
        assert r["base_failed"] == failed
        assert r["ngram_share"] == pytest.approx(share)
        assert r["kept"] == (not failed and share <= 0.3 and r["line_share"] <= 0.3)


def test_repetition_is_rejected_and_prose_kept(spark):
    clean, passage = prose(200, 3), prose(60, 4)
    texts = [clean, f"{clean}\n{passage} {passage} {passage}", clean + "\n" + "\n".join(["a line that comes back"] * 40)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.rate(documents(spark, texts)).collect()}
    assert kept == {0: True, 1: False, 2: False}


def test_quality_rules_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = quality_rules.rate(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert all(r["base_failed"] and not r["kept"] for r in found if r["doc_id"] in (None, 0, 1, 2, 3))
    assert quality_rules.rate(no_documents(spark)).collect() == []


def brute_spans(text):
    found = []
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_query(spark):
    texts = table(spark, "documents", "doc_id", "text")
    found = queries.op5_secret_scan(spark, SF_SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        spans = brute_spans(texts[r["doc_id"]] or "")
        written = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(r["spans"].split(","))


def test_base_spans_of_random_texts():
    draw = random.Random(2)
    parts = ["token", "API_KEY", "apikey", " ", "=", ":", '"', "'", "ab", "secret", "0123456789abcdef" * 2, "AKIA", "A1B2C3D4E5F6G7H8", "é", "\n", "x.y-z/9"]
    for _ in range(2000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 12)))
        assert [s for s in secret_scan.scan(text) if s[1] < 3] == brute_spans(text)


def test_novel_strings_near_sensitive_words():
    key = "q8Zx2LmN0pRtVw7yBc4DkQ"
    assert [k for _, k, _ in secret_scan.scan(f"authorization {key}")] == [3]
    assert secret_scan.scan(f"a plain sentence with {key}") == []
    assert secret_scan.scan(f"bearer abc0123456789abc0123456789\n{'x' * 80}")[:1] == secret_scan.scan("bearer abc0123456789abc0123456789")
    # Copies of a key don't make it known.
    assert [k for _, k, _ in secret_scan.scan(f"id {key} then credentials {key}")] == [3, 3]
    assert secret_scan.scan("authorization getElementByIdToString0123456789") == []


def test_masking_keeps_everything_else(spark):
    docs = odd_documents(spark)
    found = secret_scan.mask_secrets(docs)
    assert found.columns == docs.columns
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (docs, found))
    assert {i: after[i] for i in after if after[i] != before[i]} == {8: "[hex]", 10: '[assign]" and [assign]'}
    assert found.where("doc_id = 8").first()["n_chars"] == 5
    assert found.count() == docs.count()
    assert secret_scan.mask_secrets(no_documents(spark)).collect() == []
    assert secret_scan.find_secrets(no_documents(spark)).collect() == []


def brute_shards(rows, n_shards):
    """{(doc_id, digest): (shard, slot)} by the order of digest and id."""
    sizes = [(hashlib.md5(t.encode()).hexdigest() if t is not None else "", i, len((t or "").encode()) + 16) for i, t in rows]
    total, at, slots, out = sum(s for *_, s in sizes), 0, Counter(), {}
    for digest, i, size in sorted(sizes):
        at += size
        shard = (at - size // 2 - 1) * n_shards // total
        out[i] = (size, shard, slots[shard])
        slots[shard] += 1
    return out


def test_sharding_query(spark):
    texts = table(spark, "documents", "doc_id", "text")
    found = queries.op4_sharding(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["size"], r["shard"], r["slot"]) for r in found} == brute_shards(texts.items(), 40)
    assert all(r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in found)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_a_hot_text_is_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SMALL_RANGE", 0)
    texts = ["the same"] * 400 + [prose(3 + i % 40, i) for i in range(800)]
    rows = sharding.keyed_sizes(documents(spark, texts)).cache()
    splitters, sizes = sharding.find_splitters(rows, 32)
    assert sum(n for _, n, _ in sizes) == 1200
    assert max(n for _, n, _ in sizes) <= 2.5 * 1200 / 32
    found = sharding.shard_by_bytes(documents(spark, texts), 7).collect()
    assert {r["doc_id"]: (r["size"], r["shard"], r["slot"]) for r in found} == brute_shards(enumerate(texts), 7)
    rows.unpersist()


def test_sharding_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = sharding.shard_by_bytes(docs, 3).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(no_documents(spark)).collect() == []
    one = spark.createDataFrame([("x", "same")] * 50, "doc_id string, text string")
    assert sorted(Counter(r["shard"] for r in sharding.shard_by_bytes(one, 5).collect()).values()) == [10] * 5


def test_page_query(spark):
    pages = table(spark, "pages", "page_id", "html")
    found = queries.op10_html_extraction(spark, SF_SMALL).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article))).split())
        assert (r["text"], r["n_chars"]) == (expected, len(expected))


LONG = "A sentence of the article, long enough to be scored, with commas, and with words."

PAGES = [
    # Parts around an article without any semantic elements.
    f'<div id="top-menu"><a href="/">Home</a> <a href="/x">News</a></div><div id="content"><h2>Title</h2><p>{LONG}</p>'
    f'<p>Short.</p><p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div>',
    # Everything named, inside the article too.
    f"<body><header>Site</header><main><article><h1>Title</h1><p>{LONG}</p><aside>See also</aside><form><label>Mail</label></form>"
    f'<div class="cookie-notice">We use cookies</div><div class="advert">Buy</div><p>Short.</p><script>x("</p>")</script>'
    f"<style>p{{}}</style><p>{LONG}</p><section class='reader-comments'><p>{LONG}</p></section></article></main><footer>©</footer>",
    # Unclosed markup, sections, references and white space.
    f"<html><head><title>No</title><body class='has-sidebar'><div class='page sidebar-left'><article><section><p><b>Title<br></section>"
    f"<section><p>{LONG}<p>Short.&#32;\n</section><ul><li></ul><p>{LONG.replace('commas', 'com&#109;as')}</article></div>",
]


@pytest.mark.parametrize("page", PAGES)
def test_only_the_article_is_left(page):
    assert html_extraction.extract(page) == f"Title {LONG} Short. {LONG}"


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "<p>deep text" + "</div>" * 5000
    rows = [(1, None, None), (None, "u", ""), (2, "u", "no markup, at all"), (3, "u", deep), (3, "u", deep), (4, "u", "<<<>&&#x;</p></p><"), (5, "u", "<p>" + "a, " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [(r["page_id"], r["text"][:20]) for r in html_extraction.extract_pages(frame).collect()]
    assert found[:3] == [(1, ""), (None, ""), (2, "no markup, at all")]
    assert found[3] == found[4] == (3, "deep text")
    assert html_extraction.extract_pages(frame.limit(0)).collect() == []


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF_SMALL}/{table}.parquet'")
    expected = con.sql(queries.oracle_sql()[name]).df()
    found = queries.queries()[name](spark, SF_SMALL).toPandas()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = [sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).values.tolist())) for df in (found, expected)]
    assert rows[0] == rows[1]
