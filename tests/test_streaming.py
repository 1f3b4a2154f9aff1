"""The same results on a stream as on a table, over several micro-batches and restarts."""

import time

import pytest
from pyspark.sql import functions as F

from clicksieve.operators import counts, detectors
from clicksieve.plans import report
from clicksieve.schema import EVENT_COLUMNS, EVENT_SCHEMA, ORDERED_COLUMNS, PATTERN_1, PATTERN_2, PATTERN_3
from clicksieve.sources import messages, textlog
from clicksieve.streaming import sinks
from clicksieve.streaming import stateful
from clicksieve.streaming.detectors import Carried, Outputs, Rules, advance, detect_stream, read_late
from conftest import seqs
from test_random import trace

WINDOW = 600
QUICK = 30
BATCH = {PATTERN_1: detectors.clicks_without_display, PATTERN_2: detectors.quick_clicks, PATTERN_3: detectors.hyperactive_ips}


class Feed:
    """A folder that receives the events of a trace piece by piece."""

    def __init__(self, spark, folder, rows):
        self.spark, self.folder = spark, str(folder)
        self.rows = [(i, *row) for i, row in enumerate(rows, 1)]
        self.sent = 0

    def send(self, n):
        piece = self.rows[self.sent : self.sent + n]
        self.sent += len(piece)
        self.spark.createDataFrame(piece, EVENT_SCHEMA).repartition(2).write.mode("append").parquet(self.folder)

    def stream(self, **options):
        return self.spark.readStream.schema(EVENT_SCHEMA).options(**options).parquet(self.folder)

    def table(self):
        return self.spark.createDataFrame(self.rows[: self.sent], EVENT_SCHEMA)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in", trace(5, 150))


def run(writer):
    query = writer.start()
    query.awaitTermination()
    return query


def flagged(spark, folder):
    return spark.read.schema(EVENT_SCHEMA).parquet(folder)


def detect(feed, tmp_path, rules, patterns=tuple(BATCH), **more):
    outputs = {pattern: str(tmp_path / pattern[-1]) for pattern in patterns}
    run(detect_stream(feed.stream(), str(tmp_path / "work"), Outputs(outputs, **more), rules).trigger(availableNow=True))
    return outputs


def judged(pattern, events, rules):
    limits = {PATTERN_1: {}, PATTERN_2: {"threshold_seconds": rules.threshold_seconds}}
    limits[PATTERN_3] = {"min_clicks": rules.min_clicks, "min_ctr": rules.min_ctr}
    return BATCH[pattern](events, rules.semantics, rules.window_seconds, **limits[pattern])


RULES = {
    "as_coded": Rules(window_seconds=WINDOW),
    "documented": Rules("documented", 3 * WINDOW, QUICK, 4),
    "split": Rules("documented", 3 * WINDOW, QUICK, 4, group_rows=6),
    "as_coded split": Rules(window_seconds=WINDOW, group_rows=6),
}


@pytest.mark.parametrize("name", RULES)
def test_detectors(spark, feed, tmp_path, name, monkeypatch):
    """Several micro-batches, each a restart from the checkpoint, with snapshots of the state between."""
    monkeypatch.setattr("clicksieve.streaming.detectors.VERSIONS", 2)
    rules = RULES[name]
    for n in (30, 1, 49, 70):
        feed.send(n)
        outputs = detect(feed, tmp_path, rules)
        for pattern, folder in outputs.items():
            assert seqs(flagged(spark, folder)) == seqs(judged(pattern, feed.table(), rules)), pattern
    assert all(seqs(judged(pattern, feed.table(), rules)) for pattern in outputs)
    if rules.semantics != "as_coded":
        assert not (tmp_path / "work" / "carried").exists()
        assert not any((tmp_path / "work" / "staged").iterdir())
        return
    # What has been consumed is gone; so are versions before the last snapshot.
    kept = tmp_path / "work" / "carried"
    assert not any((kept / "staged").iterdir())
    assert len(list((kept / "marks").glob("batch=*"))) == 2
    assert len(list((kept / "state" / "Pattern_1").glob("batch=*"))) <= 3


def test_separate_int(spark, feed, tmp_path):
    rules = Rules("separate_int", 3 * WINDOW, min_clicks=4, min_ctr=0.8)
    for n in (80, 70):
        feed.send(n)
        outputs = detect(feed, tmp_path, rules, (PATTERN_3,))
    expected = judged(PATTERN_3, feed.table(), rules)
    assert seqs(flagged(spark, outputs[PATTERN_3])) == seqs(expected) != []
    with pytest.raises(Exception, match="semantics"):
        detect(feed_of(feed, 1), tmp_path / "other", rules, (PATTERN_1,))


def feed_of(feed, n):
    other = Feed(feed.spark, feed.folder + "-other", [r[1:] for r in feed.rows])
    other.send(n)
    return other


@pytest.mark.parametrize("name", ["as_coded", "documented"])
def test_failures_are_made_good(spark, feed, tmp_path, name):
    """A run that breaks among the detectors is repeated without loss or repetition."""
    rules = RULES[name]
    for broken in (PATTERN_1, PATTERN_3):

        def breaking(found, output, batch_id, most_rows):
            sinks.save_table(found, output, batch_id, most_rows)
            if output.endswith(broken[-1]):
                raise RuntimeError("lost")

        feed.send(75)
        with pytest.raises(Exception, match="lost"):
            detect(feed, tmp_path, rules, save=breaking)
        outputs = detect(feed, tmp_path, rules)
    for pattern, folder in outputs.items():
        assert seqs(flagged(spark, folder)) == seqs(judged(pattern, feed.table(), rules)), pattern


def test_a_lost_predecessor_raises(spark, feed, tmp_path):
    feed.send(40)
    with pytest.raises(RuntimeError, match="micro-batch 4 has not been completed"):
        advance(feed.table(), 5, str(tmp_path / "work"), Outputs({}), Rules())
    advance(feed.table(), 0, str(tmp_path / "work"), Outputs({}), Rules())
    assert Carried(spark, str(tmp_path / "work" / "carried")).mark(0).begin > 0
    # A micro-batch that is complete is left alone.
    advance(feed.table().limit(0), 0, str(tmp_path / "work"), Outputs({}), Rules())


def test_windows_behind_the_watermark_are_forgotten(spark, tmp_path):
    rows = [("display", "A", 1000 + i, "ip", "x") for i in range(3)]
    rows += [("display", "A", 100_000, "ip", "x"), ("click", "A", 100_001, "ip", "x"), ("click", "A", 100_002, "ip", "x")]
    rows += [("click", "A", 1001, "ip", "x")]  # of a forgotten window: not judged
    feed = Feed(spark, tmp_path / "in", rows)
    rules = Rules("documented", WINDOW, delay_seconds=600)
    for n in (3, 1, 2, 1):
        feed.send(n)
        outputs = detect(feed, tmp_path, rules, (PATTERN_1, PATTERN_2))
    assert seqs(flagged(spark, outputs[PATTERN_1])) == [6]
    late = read_late(spark, str(tmp_path / "work")).select("seq", "pattern").collect()
    assert sorted(map(tuple, late)) == [(7, PATTERN_1), (7, PATTERN_2)]
    state = spark.read.format("statestore").option("stateVarName", stateful.WINDOWS).load(str(tmp_path / "work" / "checkpoint"))
    assert {r[0] for r in state.select("user_map_key.window").collect()} == {100_000 // WINDOW}


def test_blacklist_of_a_checkpoint(spark, feed, tmp_path):
    rules = RULES["documented"]
    for n in (60, 90):
        feed.send(n)
        outputs = detect(feed, tmp_path, rules)
    for pattern, key in ((PATTERN_1, "uid"), (PATTERN_3, "ip")):
        found = stateful.blacklist(spark, str(tmp_path / "work" / "checkpoint"), pattern)
        expected = detectors.first_flagged(judged(pattern, feed.table(), rules), key)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) != []


def test_running_totals_in_update_mode(spark, feed, tmp_path):
    seen = []

    def keep(batch, batch_id):
        seen.append({r["event_type"]: r["n"] for r in batch.collect()})

    for n in (60, 90):
        feed.send(n)
        writer = counts.type_totals(feed.stream()).writeStream.outputMode("update").foreachBatch(keep)
        run(writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True))
    assert seen[-1] == {r["event_type"]: r["n"] for r in counts.type_totals(feed.table()).collect()}
    assert sum(seen[0].values()) == 60


def test_pattern_totals_of_flagged_streams(spark, feed, tmp_path):
    feed.send(150)
    outputs = detect(feed, tmp_path, RULES["as_coded"])
    streams = [spark.readStream.schema(EVENT_SCHEMA).parquet(f"{folder}/bucket=*/batch=*") for folder in outputs.values()]
    totals = counts.pattern_totals(counts.label_patterns(*streams))
    run(totals.writeStream.outputMode("complete").format("memory").queryName("totals").trigger(availableNow=True))
    expected = counts.pattern_totals(report.detect(feed.table(), window_seconds=WINDOW).labelled())
    assert sorted(map(tuple, spark.table("totals").collect())) == sorted(map(tuple, expected.collect()))


def test_tumbling_counts(spark, feed, tmp_path):
    feed.send(100)
    feed.send(50)
    found = counts.tumbling_counts(feed.stream(maxFilesPerTrigger="1"), "10 minutes", "1 hour")
    writer = found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
    run(writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True))
    written = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {tuple(r) for r in counts.tumbling_counts(feed.table(), "10 minutes").collect()}
    # Windows the watermark has not passed are still open.
    assert written and written < expected


def test_log_sink(spark, feed, tmp_path):
    feed.send(80)
    run(sinks.write_log(feed.stream(), folder=str(tmp_path / "all"), checkpoint=str(tmp_path / "cp"), trigger=None))
    feed.send(70)
    run(sinks.write_log(feed.stream(), folder=str(tmp_path / "all"), checkpoint=str(tmp_path / "cp"), trigger=None))
    back = textlog.read_log(spark, str(tmp_path / "all")).events
    assert sorted(map(tuple, back.collect())) == sorted(r[1:] for r in feed.rows)
    assert all(len(list(b.glob("*.txt"))) == 1 for b in (tmp_path / "all").glob("bucket=*/batch=*"))
    bucket = sorted(p.name for p in (tmp_path / "all").glob("bucket=*"))[0].removeprefix("bucket=")
    assert textlog.read_bucket(spark, str(tmp_path), "all", bucket).events.count() > 0


def test_messages_to_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"eventType":"click","uid":"u","timestamp":1,"ip":"i","impressionId":"x"}\nbroken\n')
    lines = spark.readStream.text(str(tmp_path / "in")).withColumn("topic", F.lit("clicks"))
    run(sinks.write_strings(messages.topic_strings(lines, "clicks"), str(tmp_path / "raw"), str(tmp_path / "cp1")))
    assert spark.read.text(str(tmp_path / "raw")).count() == 2
    decoded = messages.decode(lines, keep=())
    run(sinks.write_strings(decoded.rejected, str(tmp_path / "bad"), str(tmp_path / "cp2")))
    assert [r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()] == ["broken"]


def test_console_and_message_frames(feed, tmp_path):
    feed.send(20)
    query = run(sinks.print_counts(counts.type_totals(feed.stream()), str(tmp_path / "cp")))
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    assert query.lastProgress["numInputRows"] == 20
    out = sinks.fraud_messages(feed.table().select(*EVENT_COLUMNS))
    assert out.columns == ["key", "value"]
    back = messages.decode(out.withColumn("seq", F.lit(1)))
    assert back.events.count() == 20 and back.rejected.isEmpty()
    assert set(ORDERED_COLUMNS) == set(back.events.columns)


def test_roll_interval(feed, tmp_path):
    feed.send(1)
    writer = sinks.write_log(feed.stream(), folder=str(tmp_path / "all"), checkpoint=str(tmp_path / "cp"), trigger=sinks.ROLL_INTERVAL)
    query = writer.start()
    while not query.recentProgress:
        time.sleep(0.1)
    query.stop()
    assert list((tmp_path / "all").glob("bucket=*"))
