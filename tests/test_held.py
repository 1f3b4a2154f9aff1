"""Limits on micro-batches change no result where rows wait for the partitions."""

import random
from decimal import Decimal

import pytest

from clicksieve.operators import detectors
from clicksieve.schema import EVENT_SCHEMA, PATTERN_1
from clicksieve.streaming.commits import last_commit
from clicksieve.streaming.detectors import Arrival, Outputs, Rules, advance, flush
from conftest import seqs


def number(millis, topic, partition, offset):
    return Decimal(millis * 10**24 + topic * 10**23 + partition * 10**18 + offset)


@pytest.mark.parametrize("semantics", ["documented", "as_coded"])
def test_two_limits_give_one_result(spark, tmp_path, semantics):
    """Displays and clicks in two partitions each; a click comes a second after its display."""
    draw = random.Random(3)
    parts = {(topic, p): [] for topic in (1, 2) for p in (0, 1)}
    for i in range(60):
        second, user = 1000 + 2 * i, f"u{i % 7}"
        for topic, kind, at in ((2, "display", second), (1, "click", second + 1)):
            if topic == 1 or i % 10:
                rows = parts[topic, draw.randrange(2)]
                rows.append((at, kind, user, i))
    types = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA.fields} | {"seq": "decimal(38,0)"}

    def frame(batch):
        rows = []
        for (topic, p), (first, piece) in batch.items():
            for k, (at, kind, user, i) in enumerate(piece, first):
                values = {"seq": number(at * 1000, topic, p, k), "event_type": kind, "uid": user, "timestamp": at, "ip": "a", "impression_id": f"m{i}"}
                rows.append(tuple(values[f.name] for f in EVENT_SCHEMA.fields))
        return spark.createDataFrame(rows, ", ".join(f"{f.name} {types[f.name]}" for f in EVENT_SCHEMA.fields))

    whole = frame({place: (0, rows) for place, rows in parts.items()})
    rules = Rules(semantics, 100_000 if semantics == "documented" else 40)
    expected = seqs(detectors.clicks_without_display(whole, semantics, rules.window_seconds))
    assert expected
    # One limit for all, and one that lets clicks run ahead of their displays.
    for name, limits in (("all", {1: 99, 2: 99}), ("ahead", {1: 25, 2: 11})):
        found, sent, batch_id, arrival = [], dict.fromkeys(parts, 0), 0, Arrival(4, None)

        def save(rows, output, batch_id, most_rows, found=found):
            found.extend(seqs(rows))

        outputs, folder = Outputs({PATTERN_1: "out"}, save), str(tmp_path / name)
        while any(sent[p] < len(parts[p]) for p in parts):
            piece = {p: (sent[p], parts[p][sent[p] : sent[p] + limits[p[0]]]) for p in parts}
            for p in parts:
                sent[p] += len(piece[p][1])
            advance(frame(piece), batch_id, folder, outputs, rules, arrival)
            batch_id += 1
        # Until the input is said to have ended, the last rows wait.
        assert len(found) < len(expected)
        flush(whole, folder, outputs, rules, arrival)
        flush(whole, folder, outputs, rules, arrival)
        assert sorted(found) == expected
        assert batch_id == 1 or name == "ahead"
        # The source may go on after that.
        more = {(1, 0): (500, [(9000, "click", "new", 500)])}
        advance(frame(more), batch_id, folder, outputs, rules, arrival)
        flush(whole, folder, outputs, rules, arrival)
        assert set(found) - set(expected) == {number(9_000_000, 1, 0, 500)}
        with pytest.raises(RuntimeError, match="have to be named"):
            advance(frame(more), batch_id + 1, folder, outputs, rules)


EVENTS = ", ".join(f"{f.name} {'decimal(38,0)' if f.name == 'seq' else f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)


def clicks(spark, *rows):
    """Clicks as (partition, second), each of a user without displays."""
    return spark.createDataFrame([(number(at * 1000, 1, p, at), "click", f"u{p}", at, "a", "m") for p, at in rows], EVENTS)


def test_an_idle_partition_is_not_waited_for(spark, tmp_path):
    now, found = [1000.0], []
    outputs = Outputs({PATTERN_1: "out"}, lambda rows, output, batch_id, most_rows: found.append([int(s) // 10**27 for s in seqs(rows)]))
    arrival = Arrival(3, 60, lambda: now[0])
    steps = [
        # (seconds later, records, seconds of the clicks judged)
        (0, [(0, 10), (1, 12)], []),  # the third partition may still bring earlier ones
        (30, [(0, 20), (1, 11)], []),
        (40, [(0, 30), (1, 31)], [10, 11, 12, 20]),  # it hasn't for more than a minute
        (10, [(2, 25)], []),  # now it does; all have passed 25, and 30 and 31 wait for it
        (30, [(0, 40), (1, 41)], []),
        (40, [(0, 50), (1, 51)], [25, 30, 31, 40, 41]),
    ]
    for batch_id, (later, records, expected) in enumerate(steps):
        now[0] += later
        found.clear()
        advance(clicks(spark, *records), batch_id, str(tmp_path), outputs, Rules("documented", 10_000), arrival)
        assert sorted(sum(found, [])) == expected, batch_id
    # As late as it comes, it is judged.
    found.clear()
    flush(clicks(spark, (0, 1)), str(tmp_path), outputs, Rules("documented", 10_000), arrival)
    assert sum(found, []) == [50, 51]


def test_a_flush_that_breaks_is_made_good(spark, tmp_path):
    found, broken = [], [False]

    def save(rows, output, batch_id, most_rows):
        if broken[0]:
            raise RuntimeError("lost")
        found.extend(int(s) // 10**27 for s in seqs(rows))

    outputs, rules, arrival = Outputs({PATTERN_1: "out"}, save), Rules(window_seconds=1000), Arrival(2)
    advance(clicks(spark, (0, 10), (1, 12)), 0, str(tmp_path), outputs, rules, arrival)
    assert found == []
    broken[0] = True
    with pytest.raises(RuntimeError, match="lost"):
        flush(clicks(spark, (0, 1)), str(tmp_path), outputs, rules, arrival)
    broken[0] = False
    # The rows it had to take go before those of the next micro-batch.
    advance(clicks(spark, (0, 20), (1, 5)), 1, str(tmp_path), outputs, rules, arrival)
    assert found == [10, 12, 5]
    flush(clicks(spark, (0, 1)), str(tmp_path), outputs, rules, arrival)
    assert found == [10, 12, 5, 20]
    assert last_commit(spark, str(tmp_path)) == 3
