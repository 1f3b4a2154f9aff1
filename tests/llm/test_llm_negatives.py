"""Hard negatives: the threshold algorithm against scoring everything."""

import random
from collections import Counter
from math import floor, isfinite

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clicksieve.llm import hard_negatives, queries
from samples import SF_SMALL

LAST = (1 << 63) - 1


def brute(rows, every=100, k=5, low_percent=80):
    """(anchor, positive, rank, negative, both scores) of (id, vector, label) rows."""
    whole = []
    for i, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and isfinite(x) for x in vector):
            whole.append((i, [min(max(floor(256 * x), -LAST - 1), LAST) for x in vector], label))
    out = []
    for n, (i, v, label) in enumerate(whole):
        if i is None or i % every:
            continue
        scored = [
            (min(max(sum(a * b for a, b in zip(v, w, strict=False)), -LAST - 1), LAST), LAST if j is None else j, m, other)
            for m, (j, w, other) in enumerate(whole)
            if m != n
        ]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for high, j, *_ in [s for s in scored if s[3] == label][:k]:
            hard = [s for s in scored if s[3] != label and low_percent * high <= 100 * s[0] <= 100 * high][:k]
            out += [(i, None if j == LAST else j, r, None if h[1] == LAST else h[1], high, h[0]) for r, h in enumerate(hard, 1)]
    return Counter(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def result(df):
    return Counter(map(tuple, df.select(*COLUMNS).collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_query_against_brute_force_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected = brute([(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows])
    assert expected
    assert result(queries.op11_hard_negatives(spark, SF_SMALL)) == expected
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF_SMALL}/embeddings.parquet'")
    assert Counter(con.sql(queries.oracle_sql()["op11_hard_negatives"]).select(", ".join(COLUMNS)).fetchall()) == expected


@pytest.mark.parametrize("seed", range(4))
def test_small_blocks_and_ties(spark, seed):
    draw = random.Random(seed)
    # Few values, so that many scores tie; some zeros and some rows again.
    rows = [(i, [draw.randint(-2, 3) / 256 for _ in range(4)], draw.randint(0, 2)) for i in range(150)]
    rows += [(draw.randrange(200), r[1], r[2]) for r in draw.sample(rows, 20)]
    rows[10] = (10, [0.0] * 4, 1)
    frame = table(spark, rows).repartition(3)
    anchors = F.col("vec_id") % 10 == 0
    found = hard_negatives.mine(frame, is_anchor=anchors, block_rows=40, anchor_rows=6, low_percent=50)
    assert result(found) == brute(rows, 10, low_percent=50)


def test_odd_rows(spark):
    draw = random.Random(9)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(3)], i % 2) for i in range(30)]
    rows += [(0, None, 1), (100, [1.0, None, 2.0], 1), (200, [float("nan"), 1.0, 1.0], 1), (300, [float("inf"), 1.0], 0), (400, [1.0, 1.0], None)]
    rows += [(None, [0.5, 0.5, 0.5], 0), (None, [0.5, 0.5, 0.5], 1), (None, None, None), (500, [], 0), (600, [0.25], 1), (700, [1.0, 0.5, 0.5, 9.0], 0)]
    rows += [(0, [0.7, 0.1, 0.3], 0), (0, [0.7, 0.1, 0.3], 1), (800, [1e300, -1e300, 5.0], 0), (801, [3e14, 1.0, 2.0], 0), (802, [2e14, 1.0, 2.0], 1)]
    frame = table(spark, rows)
    clashing = frame.selectExpr("*", "'a' as row", "1 as id", "'b' as vector", "2 as block", "3 as part", "4 as score", "5 as high")
    for blocks in ({}, {"block_rows": 7, "anchor_rows": 2}):
        assert result(hard_negatives.mine(clashing, is_anchor=F.col("vec_id") % 100 == 0, **blocks)) == brute(rows)
    # Without a condition every row with an id is an anchor.
    assert result(hard_negatives.mine(frame)) == brute(rows, 1)
    empty = hard_negatives.mine(table(spark, []))
    assert empty.columns == COLUMNS and empty.collect() == []


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 20])
def test_stops_before_the_end_of_the_lists(size):
    draw = np.random.default_rng(size)
    # Long vectors are few; the lists have them at their ends.
    vectors = draw.integers(-3, 4, (5000, 4)) * size
    vectors[:40] *= 1000
    anchor = np.array([3, -2, 0, 1]) * size
    lists = hard_negatives.Lists(list(vectors), np.arange(5000), np.zeros(5000, int), np.arange(5000), 4, 3 * size)
    scored = []
    first = lists.first
    lists.first = lambda scores, at, k: (scored.append(at), first(scores, at, k))[1]
    scores = [sum(int(a) * int(b) for a, b in zip(anchor, v, strict=True)) for v in vectors]
    best = sorted(range(5000), key=lambda i: (-scores[i], i))[:5]
    assert lists.search(anchor, np.ones(5000, bool), [(None, None)], 5) == [[(scores[i], i) for i in best]]
    assert len(set(np.concatenate(scored).tolist())) < 1000
    high = scores[best[2]]
    in_window = [i for i in sorted(range(5000), key=lambda i: (-scores[i], i)) if high // 2 <= scores[i] <= high][:5]
    assert lists.search(anchor, np.ones(5000, bool), [(high // 2, high)], 5) == [[(scores[i], i) for i in in_window]]
