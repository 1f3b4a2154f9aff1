"""Hand-made traces with the result each rule must give."""

import pytest

from clicksieve.operators.boundaries import window_boundaries
from clicksieve.operators.detectors import clicks_without_display, hyperactive_ips, quick_clicks
from clicksieve.plans import report
from conftest import seqs


def by_uid(*rows):
    return [(kind, key, ts, "ip", "x") for kind, key, ts in rows]


def by_impression(*rows):
    return [(kind, "u", ts, "ip", key) for kind, key, ts in rows]


P1_TRACES = {
    "sticky": (
        [("display", "A", 100), ("click", "A", 101), ("click", "A", 102), ("display", "A", 103), ("click", "A", 104), ("click", "B", 105)],
        [],
        [3, 5, 6],
        [3, 5, 6],
    ),
    "only the boundary key is cleared": (
        [("display", "A", 1000), ("display", "B", 1001), ("click", "A", 2800), ("click", "B", 2801)],
        [3],
        [3],
        [3, 4],
    ),
    "one second short of a window": ([("display", "A", 1000), ("click", "A", 2799)], [], [], [2]),
    "late event": (
        [("display", "A", 1000), ("display", "B", 2800), ("click", "A", 1500), ("display", "A", 4599), ("click", "B", 4600)],
        [2, 5],
        [5],
        [5],
    ),
    "any other type is a click": ([("view", "A", 100)], [], [1], [1]),
}


@pytest.mark.parametrize("name", P1_TRACES)
@pytest.mark.parametrize("group_rows", [None, 1])
def test_clicks_without_display(frame, name, group_rows):
    rows, bounds, as_coded, documented = P1_TRACES[name]
    events = frame(by_uid(*rows))
    assert seqs(window_boundaries(events)) == bounds
    assert seqs(clicks_without_display(events, group_rows=group_rows)) == as_coded
    assert seqs(clicks_without_display(events, "documented", group_rows=group_rows)) == documented


@pytest.mark.parametrize("group_rows", [None, 1])
def test_quick_clicks(frame, group_rows):
    events = frame(
        by_impression(
            ("display", "X", 100), ("click", "X", 500), ("click", "X", 101), ("click", "X", 99), ("click", "X", 98), ("click", "Y", 100)
        )
    )
    assert seqs(quick_clicks(events, group_rows=group_rows)) == [2, 3, 4]
    assert seqs(quick_clicks(events, "documented", group_rows=group_rows)) == [3]


def test_hyperactive_ip_counts_everything_and_emits_twice(frame):
    events = frame([("display", "u", 100, "I", "x")] * 9 + [("click", "u", 100, "I", "x")] * 2)
    assert seqs(hyperactive_ips(events)) == [10, 11, 11]
    assert seqs(hyperactive_ips(events, "documented")) == []


@pytest.mark.parametrize("group_rows", [None, 4])
def test_hyperactive_ip_readings(frame, group_rows):
    events = frame([("display", "u", 100, "I", "x")] * 20 + [("click", "u", 100, "I", "x")] * 10)
    coded = seqs(hyperactive_ips(events, group_rows=group_rows))
    assert (len(coded), len(set(coded))) == (19, 10)
    assert seqs(hyperactive_ips(events, "documented", group_rows=group_rows)) == [30]
    assert seqs(hyperactive_ips(events, "separate_int", group_rows=group_rows)) == []


def test_unknown_semantics(frame):
    with pytest.raises(ValueError):
        clicks_without_display(frame(by_uid(("click", "A", 1))), "separate_int")


def test_report(frame):
    events = frame(
        [("display", f"d{i}", 100 + i, "ip", "x") for i in range(10)] + [("click", f"c{i}", 200 + i, "ip", "x") for i in range(1, 5)]
    )
    c1, c2, c3 = (events.where(f"uid = 'c{i}'") for i in (1, 2, 3))
    found = report.Detection(events, c1.union(c2), c2.union(c3), c3.union(c3))
    assert found.union_all().count() == 6
    assert found.distinct().count() == 3
    assert report.ctr(events).first()["ctr"] == 0.4
    after = report.ctr_after_fraud(found).first()
    assert (after["n_invalid"], after["ctr"], after["n_1"], after["n_2"], after["n_3"]) == (3, 0.1, 2, 2, 2)
    assert [r["text"] for r in report.report_lines(found).orderBy("line_no").collect()] == [
        "The click-through-rate equals 40.0%.",
        "3 clicks have been detected as fraudulent out of 4 clicks.",
        "The click-through-rate equals 10.0%.",
        "The pattern that detects clicks without corresponding displays flagged 2 clicks.",
        "The pattern that detects clicks that occured too fast flagged 2 clicks.",
        "The pattern that detects clicks with hyperactive IP addresses 2 clicks.",
    ]


def test_report_without_displays(frame):
    events = frame(by_uid(("click", "A", 1), ("click", "B", 2)))
    assert report.ctr(events).first()["ctr"] is None


def test_events_equal_but_for_arrival_are_one(frame):
    events = frame(by_uid(("click", "A", 1), ("click", "A", 1)))
    assert report.detect(events).distinct().count() == 1


def test_nothing_at_all(frame, spark):
    events = frame(by_uid(("click", "A", 1))).where("seq > 1")
    assert report.detect(events).union_all().count() == 0
    after = report.ctr_after_fraud(report.detect(events)).first()
    assert (after["n_clicks"], after["n_invalid"], after["ctr"]) == (0, 0, None)
