"""Source divergence audit against a plain count."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from clicksieve.llm import queries, source_audit
from samples import SF_SMALL, no_documents, odd_documents

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, min_documents=10, top=10):
    """Rows of the audit for (text, lang, source) rows."""
    groups, whole, n_docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(found)
        whole[lang].update(found)
        n_docs[lang].update(set(found))
    out = []
    for lang in n_docs:
        kept = [t for t, n in n_docs[lang].items() if n >= min_documents]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        q = shares(whole[lang])
        sources = {source: shares(counts) for (at, source), counts in groups.items() if at == lang}
        for source, p in sources.items():
            pairs = [(sum(f(p[t], o[t]) for t in kept), item) for item, o in sources.items() if item != source]
            terms = [(f(p[t], q[t]), t) for t in kept if groups[lang, source][t] and p[t] > q[t]]
            for part, ranked, most in (("pair", pairs, None), ("term", terms, top)):
                ranked.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ranked[:most], 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_query_against_brute_force_and_sql(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source").collect()
    expected = brute(rows)
    assert {r[2] for r in expected} == {"pair", "term"}
    assert result(queries.op13_source_audit(spark, SF_SMALL)) == expected
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    assert sorted(con.sql(queries.oracle_sql()["op13_source_audit"]).select(", ".join(COLUMNS)).fetchall()) == expected


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("seed", range(2))
def test_small_blocks_and_ties(spark, seed):
    draw = random.Random(seed)
    # Few words, so that many terms have equal counts.
    words = [f"{a}{b}" for a in "abcé\U0001f600" for b in "xyzÄ"]
    rows = [
        (" ".join(draw.choices(words, k=draw.randint(0, 12))), draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", "S4", "ß", None]))
        for _ in range(120)
    ]
    rows += [(None, "en", "silent"), ("", "xx", "alone"), ("few words here", "yy", "a"), (None, "yy", "b"), ("12 34", "zz", "a")]
    frame = table(spark, rows).repartition(3)
    expected = brute(rows, 4)
    for blocks in ({"block_terms": 3, "block_sources": 2}, {"block_terms": 1, "block_sources": 1})[: 2 - seed]:
        assert result(source_audit.audit(frame, 4, **blocks)) == expected


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "1 as n", "2 as value", "'c' as rank", "'d' as part", "'e' as term")
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert result(source_audit.audit(docs)) == brute(rows)
    assert result(source_audit.audit(docs, 2)) == brute(rows, 2)
    empty = source_audit.audit(no_documents(spark))
    assert empty.columns == COLUMNS and empty.collect() == []


def test_large_counts_stay_exact(spark):
    # 10^9 times such counts is beyond a long.
    n, total, kept = 9_000_000_000_000_000, 9_007_199_254_740_993, 12_345
    frame = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long")
    share = source_audit._share(frame["n"], frame["total"], frame["kept"])
    assert frame.select(share).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    rows = [(f"wort{chr(97 + i % 7)} rest{chr(97 + i % 3)}", "de", f"s{i % 2}") for i in range(200)]
    monkeypatch.setattr(source_audit, "COUNTED_TERMS", 2)
    monkeypatch.setattr(source_audit, "TOGETHER", 10)
    assert result(source_audit.audit(table(spark, rows).repartition(5))) == brute(rows)
