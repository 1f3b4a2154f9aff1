"""Random traces, late events included, against the rules by definition.

One key holds a third of the events, and the split versions run with groups of
a few rows.
"""

import random

import pytest
from pyspark.sql import functions as F

import brute
from clicksieve.operators import boundaries, counts, detectors
from clicksieve.schema import EVENT_SCHEMA
from conftest import seqs

WINDOW = 600


def trace(seed, n=300):
    rng = random.Random(seed)
    ts, rows = 100_000, []
    for _ in range(n):
        ts += rng.choice([0, 0, 1, 3, 40, 90, 700 if rng.random() < 0.1 else 5])
        late = rng.choice([0, 0, 0, rng.randint(1, 900)])

        def key(prefix):
            return prefix + ("0" if rng.random() < 0.33 else str(rng.randint(1, 6)))

        kind = rng.choices(["display", "click", "view"], [6, 5, 1])[0]
        rows.append((kind, key("u"), ts - late, key("ip"), key("x")))
    return rows


@pytest.fixture(scope="module", params=range(2))
def case(request, spark):
    rows = trace(request.param)
    # Scattered over files and out of order, as tables are.
    events = spark.createDataFrame([(10 * i, *row) for i, row in enumerate(rows, 1)], EVENT_SCHEMA)
    return rows, events.repartition(5, F.rand(1))


def tens(flagged):
    return sorted(10 * i for i in flagged)


@pytest.mark.parametrize("stretch", [None, 50, 700, 5000])
def test_boundaries(case, stretch):
    rows, events = case
    expected = sorted(10 * (i + 1) for i in brute.boundaries(rows, WINDOW))
    assert len(expected) > 5
    assert seqs(boundaries.window_boundaries(events, WINDOW, stretch_seconds=stretch)) == expected


def test_boundaries_continue_from_a_given_begin(case):
    rows, events = case
    found = boundaries.window_boundaries(events, WINDOW).orderBy("seq").collect()
    for cut in (0, len(found) // 2):
        rest = events.where(F.col("seq") > found[cut]["seq"])
        again = boundaries.window_boundaries(rest, WINDOW, found[cut]["timestamp"], 700)
        assert seqs(again) == [r["seq"] for r in found[cut + 1 :]]


@pytest.mark.parametrize("group_rows", [None, 7])
def test_as_coded(case, group_rows):
    rows, events = case
    reset = brute.boundaries(rows, WINDOW)
    shared = {
        "window_seconds": WINDOW,
        "lookup": boundaries.boundary_lookup(events, WINDOW),
        "total_rows": len(rows),
        "group_rows": group_rows,
    }
    p1 = brute.p1(rows, reset=reset)
    p2 = brute.p2(rows, lambda shown, clicked: shown - clicked < 2, reset=reset)
    p3 = brute.p3(rows, lambda clicks, displays: clicks + displays >= 10, twice=True, reset=reset)
    assert p1 and p2 and len(p3) > len(set(p3)) > 0
    assert seqs(detectors.clicks_without_display(events, **shared)) == tens(p1)
    assert seqs(detectors.quick_clicks(events, **shared)) == tens(p2)
    assert seqs(detectors.hyperactive_ips(events, **shared)) == tens(p3)


@pytest.mark.parametrize("group_rows", [None, 7])
def test_documented(case, group_rows):
    rows, events = case
    shared = {"window_seconds": 6 * WINDOW, "total_rows": len(rows), "group_rows": group_rows}
    p1 = brute.p1(rows, window=6 * WINDOW)
    p2 = brute.p2(rows, lambda shown, clicked: 0 <= clicked - shown < 30, window=6 * WINDOW)
    p3 = brute.p3(rows, lambda c, d: c >= 10 and d > 0 and c / d >= 0.8, window=6 * WINDOW)
    p3_int = brute.p3(rows, lambda c, d: c >= 10 and d > 0 and c // d >= 0.8, window=6 * WINDOW)
    assert p1 and p2 and p3 and p3 != p3_int
    assert seqs(detectors.clicks_without_display(events, "documented", **shared)) == tens(p1)
    assert seqs(detectors.quick_clicks(events, "documented", threshold_seconds=30, **shared)) == tens(p2)
    limits = {"min_clicks": 10, "min_ctr": 0.8}
    assert seqs(detectors.hyperactive_ips(events, "documented", **limits, **shared)) == tens(p3)
    assert seqs(detectors.hyperactive_ips(events, "separate_int", **limits, **shared)) == tens(p3_int)


@pytest.mark.parametrize("group_rows", [None, 7])
def test_running_counts(case, group_rows):
    rows, events = case
    expected = {10 * (i + 1): sum(r[0] == row[0] for r in rows[: i + 1]) for i, row in enumerate(rows)}
    counted = counts.running_counts(events, group_rows=group_rows).collect()
    assert {r["seq"]: r["n"] for r in counted} == expected


@pytest.mark.parametrize("group_rows", [None, 7])
def test_segments(case, group_rows):
    rows, events = case
    reset = brute.boundaries(rows, WINDOW)
    expected = {
        10 * (i + 1): tuple(sum(j in reset and rows[j][k] == rows[i][k] for j in range(i + 1)) for k in (1, 4, 3))
        for i in range(len(rows))
    }
    found = detectors.key_segments(events, WINDOW, group_rows=group_rows).collect()
    assert {r["seq"]: (r["seg_uid"], r["seg_impression"], r["seg_ip"]) for r in found} == expected


def test_large_sides_join_by_shuffle(case, monkeypatch):
    """With no broadcast allowed, results are the same."""
    rows, events = case
    for module in ("boundaries", "running"):
        monkeypatch.setattr(f"clicksieve.operators.{module}.small_side", lambda df: df)
    expected = brute.p1(rows, reset=brute.boundaries(rows, WINDOW))
    found = detectors.clicks_without_display(events, window_seconds=WINDOW, group_rows=7)
    assert seqs(found) == tens(expected)
