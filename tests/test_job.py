"""From a stream of messages to the report on one hour."""

import json

import pytest
from pyspark.sql import functions as F

from clicksieve.functions.columns import event_json, hour_bucket
from clicksieve.operators import counts
from clicksieve.plans import job, report
from clicksieve.schema import EVENT_COLUMNS
from clicksieve.sources import textlog
from clicksieve.sources.messages import decode
from clicksieve.streaming.detectors import Rules
from test_random import trace
from test_streaming import WINDOW, Feed


def log(spark, folder, output):
    return textlog.read_log(spark, f"{folder}/{textlog.OUTPUTS[output]}").events


@pytest.mark.parametrize("semantics", ["as_coded", "documented"])
def test_job_and_report(spark, tmp_path, semantics):
    feed = Feed(spark, tmp_path / "in", trace(7, 120))
    folder = str(tmp_path / "outputs")
    for _ in range(2):
        feed.send(60)
        job.run_job(feed.stream(), folder, Rules(semantics, WINDOW), trigger=None)

    found = report.detect(feed.table(), semantics, WINDOW)
    for output, expected in [("all", feed.table()), ("Pattern 1", found.p1), ("Pattern 2", found.p2), ("Pattern 3", found.p3)]:
        written = log(spark, folder, output)
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, expected.select(*EVENT_COLUMNS).collect()))
    totals = {(r["pattern"], r["event_type"]): r["n"] for r in job.read_totals(spark, folder).collect()}
    assert totals == {(None, r[0]): r[1] for r in counts.type_totals(feed.table()).collect()} | {
        (r["pattern"], r["event_type"]): r["n"] for r in counts.pattern_totals(found.labelled()).collect()
    }

    bucket = feed.table().select(hour_bucket()).first()[0]

    def hour(df):
        return df.where(hour_bucket() == bucket)

    expected = report.report_lines(
        report.Detection(hour(feed.table()), hour(found.p1), hour(found.p2), hour(found.p3))
    )
    assert job.hour_report(spark, folder, bucket).collect() == expected.collect()


def test_order_by_kafka_position(spark, tmp_path):
    """The arrival order of Kafka records is a wide decimal."""
    feed = Feed(spark, tmp_path / "in", trace(8, 60))
    folder = str(tmp_path / "outputs")
    for n in (25, 35):
        feed.send(n)
        wide = feed.stream().withColumn("seq", F.expr("cast(seq * 100000000000000000000bd as decimal(38,0))"))
        job.run_job(wide, folder, Rules(window_seconds=WINDOW), trigger=None)
    found = counts.pattern_totals(report.detect(feed.table(), window_seconds=WINDOW).labelled())
    totals = job.read_totals(spark, folder).where("pattern is not null").select("event_type", "pattern", "n")
    assert sorted(totals.collect()) == sorted(found.collect())


def test_no_message_ends_the_job_and_none_vanishes(spark, tmp_path):
    good = {"eventType": "click", "uid": "u", "timestamp": 1625760000, "ip": "i", "impressionId": "x"}
    odd = [
        good | {"uid": "line\nbreak", "ip": "car\rriage", "impressionId": "back\\slash\\n"},
        good | {"timestamp": 2**63 - 1},
        good | {"timestamp": 253_402_300_800},
        good | {"timestamp": "12"},
        {k: v for k, v in good.items() if k != "ip"},
        good | {"uid": None},
        good | {"timestamp": -5},
        good,
    ]
    texts = [json.dumps(m) for m in odd] + ["junk", "", '{"eventType":']
    messages = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    messages.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "out")
    job.run_job(decode(stream), folder, trigger=None)

    def five(m):
        return (m["eventType"], m["uid"], m["timestamp"], m["ip"], m["impressionId"])

    assert sorted(map(tuple, log(spark, folder, "all").collect())) == sorted(map(five, [odd[0], odd[6], odd[7]]))
    rejected = {r["seq"]: r["value"] for r in job.read_rejected(spark, folder).collect()}
    assert rejected == {i: texts[i] for i in (1, 2, 3, 4, 5, 8, 9, 10)}
    lines = job.hour_report(spark, folder, "2021-07-08--16").collect()
    assert lines[1]["text"] == "2 clicks have been detected as fraudulent out of 2 clicks."


def test_all_outputs_cover_the_same_events(spark, tmp_path):
    """Messages that arrive while the job is down are in every output or in none."""
    feed = Feed(spark, tmp_path / "in", trace(9, 90))
    folder = str(tmp_path / "outputs")
    for n in (30, 20, 40):
        feed.send(n)
        job.run_job(decode(feed.stream().select("seq", event_json().alias("value"))), folder, trigger=None)
        seen = log(spark, folder, "all").count()
        totals = job.read_totals(spark, folder).where("pattern is null").agg(F.sum("n")).first()[0]
        assert seen == totals == feed.sent
