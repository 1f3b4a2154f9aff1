"""Decoding, the text log, and frames laid out like Kafka's."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicksieve.functions.columns import event_json, event_line, event_time, hour_bucket, percent, role, utc_time
from clicksieve.schema import EVENT_COLUMNS, EVENT_SCHEMA
from clicksieve.sources import messages, tables, textlog
from clicksieve.streaming import sinks

EVENT = ("click", "u1", 1625760000, "1.2.3.4", "i1")


def five(df):
    return sorted(tuple(r) for r in df.select(*EVENT_COLUMNS).collect())


def test_decode_and_quarantine(spark):
    texts = [
        '{"eventType":"click","uid":"u1","timestamp":1625760000,"ip":"1.2.3.4","impressionId":"i1"}',
        "not json",
        '{"eventType":"click","uid":"u1","timestamp":"12","ip":"i","impressionId":"x"}',
        '{"eventType":"click","timestamp":12}',
        '{"eventType":null,"uid":"u1","timestamp":1,"ip":"i","impressionId":"x"}',
        "",
        None,
        '{"uid":"ü","impressionId":"b","extra":1,"timestamp":7,"eventType":"display","ip":"a"}',
    ]
    raw = [(i, None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    decoded = messages.decode(spark.createDataFrame(raw, "seq long, value binary"))
    assert five(decoded.events) == [EVENT, ("display", "ü", 7, "a", "b")]
    assert sorted(r["seq"] for r in decoded.rejected.collect()) == [1, 2, 3, 4, 5, 6]


@pytest.fixture
def records(spark):
    at = datetime(2021, 7, 8, 16)
    text = '{"eventType":"click","uid":"u%d","timestamp":1625760000,"ip":"i","impressionId":"x"}'
    rows = [
        ("clicks", 1, 5, at, None, bytearray((text % 1).encode())),
        ("displays", 0, 9, at, bytearray(b"k"), bytearray(b"{}")),
        ("clicks", 0, 7, at, None, bytearray((text % 2).encode())),
        ("clicks", 0, 8, datetime(2021, 7, 8, 15), None, bytearray((text % 3).encode())),
    ]
    return spark.createDataFrame(
        rows, "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"
    )


def test_kafka_records_in_arrival_order(records):
    decoded = messages.record_events(records)
    assert [r["uid"] for r in decoded.events.orderBy("seq").collect()] == ["u3", "u2", "u1"]
    assert decoded.rejected.count() == 1


def test_detectors_take_that_order(records):
    from clicksieve.plans import report

    events = messages.record_events(records).events
    assert report.detect(events).p1.count() == 3
    assert report.detect(events, group_rows=1).p1.count() == 3


def test_topic_strings_and_record_lines(records):
    assert messages.topic_strings(records, "displays").collect()[0]["value"] == "{}"
    lines = [r["line"] for r in messages.record_lines(records).collect()]
    assert "offset = 9, key = k, value = {}" in lines
    assert any(line.startswith("offset = 5, key = null, value = {") for line in lines)


def test_kafka_source_names_its_topics(spark):
    """The connector is not in this image, so Spark has to complain about exactly that."""
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_records(spark, "localhost:9092")


def test_order_is_unique_over_topics(spark, records):
    """Records of two topics with equal timestamp, partition and offset."""
    both = records.unionByName(records.withColumn("topic", F.lit("displays"))).distinct()
    order = both.select(messages.arrival_order().alias("seq"))
    assert order.distinct().count() == both.count() == 7
    widest = both.limit(1).select(
        F.lit("displays").alias("topic"), F.lit(99_999).alias("partition"), F.lit(10**18 - 1).alias("offset"),
        F.timestamp_seconds(F.lit(99_999_999_999)).alias("timestamp"),
    )
    assert str(widest.select(messages.arrival_order()).first()[0]) == "99999999999000" + "2" + "99999" + "9" * 18


def test_json_lines(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"eventType":"click","uid":"u1","timestamp":1625760000,"ip":"1.2.3.4","impressionId":"i1"}\nbroken\n'
    )
    found = messages.json_line_events(spark, str(tmp_path))
    df = messages.named_topic(found.events)
    assert df.columns == ["topic", *EVENT_COLUMNS[1:]]
    assert [tuple(r) for r in df.collect()] == [EVENT]
    assert [r["value"] for r in found.rejected.collect()] == ["broken"]


def test_log_lines(spark, frame):
    rows = [EVENT, ("display", "a b", -5, "it's, so", "x'"), ("click", None, None, "i", "x")]
    lines = [r[0] for r in frame(rows).orderBy("seq").select(event_line()).collect()]
    assert lines[0] == "Event{eventType='click', uid='u1', timestamp=1625760000, ip='1.2.3.4', impressionId='i1'}"
    assert lines[2] == "Event{eventType='click', uid='null', timestamp=null, ip='i', impressionId='x'}"
    bad = ["junk", "", lines[0].replace("1625760000", "1" * 20), lines[0].replace("1625760000", "9" * 13)]
    parsed = textlog.parse_lines(spark.createDataFrame([(x,) for x in [*lines, *bad, None]], "value string"))
    found = [tuple(r) for r in parsed.events.collect()]
    assert found == [EVENT, rows[1], ("click", "null", None, "i", "x")]
    assert [r["value"] for r in parsed.rejected.collect()] == [*bad, None]


def test_any_value_survives_the_log(spark, frame):
    values = ["a\nb", "\r", "\\", "\\n", "\\\\r\n\\", "', ip='", "\u2028", "x\\"]
    rows = [("click", v, 5, v, v[::-1]) for v in values]
    lines = frame(rows).select(event_line().alias("value"))
    assert not any("\n" in r[0] or "\r" in r[0] for r in lines.collect())
    back = textlog.parse_lines(lines).events
    assert sorted(map(tuple, back.where("uid <> \"', ip='\"").collect())) == sorted(r for r in rows if r[1] != "', ip='")


def test_log_folders_round_trip(spark, frame, tmp_path):
    events = frame([EVENT, ("display", "u2", 1625760000 + 3600, "i", "x"), ("click", "u3", 1625759999, "i", "x")])
    folder = str(tmp_path / "all")
    sinks.save_log(events, folder)
    assert (tmp_path / "all" / "bucket=2021-07-08--16").is_dir()
    assert five(textlog.read_log(spark, folder).events) == five(events)
    hour = textlog.read_bucket(spark, str(tmp_path), "all", "2021-07-08--16").events
    assert five(hour) == [EVENT]
    read = textlog.bucket_lines(spark, folder, "2021-07-08--16").inputFiles()
    assert read and all("/bucket=2021-07-08--16/" in file for file in read)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session(spark, frame, zone):
    events = frame([EVENT, ("click", "u", 1615705200, "i", "x")])
    found = tables.click_events(spark, "/root/testdata/sf0.001").agg(F.sum("timestamp"), F.min("impression_id")).first()
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = events.select(hour_bucket().alias("hour"), utc_time(F.col("timestamp")).cast("string").alias("at")).collect()
        again = tables.click_events(spark, "/root/testdata/sf0.001").agg(F.sum("timestamp"), F.min("impression_id")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == [("2021-07-08--16", "2021-07-08 16:00:00"), ("2021-03-14--07", "2021-03-14 07:00:00")]
    assert again == found


def test_percent_rounds_as_decimal_format_does(spark):
    found = spark.createDataFrame([(0.0625,), (0.0015,), (0.0, ), (1.0121,), (12.5,)], "r double").select(percent(F.col("r")))
    assert [r[0] for r in found.collect()] == ["6.2%", "0.1%", "0.0%", "101.2%", "1250.0%"]


def test_columns(frame):
    row = frame([EVENT, ("view", "u", 0, "i", "x")]).orderBy("seq")
    first = row.select(
        role().alias("role"), event_time().cast("string").alias("at"), hour_bucket().alias("hour"), event_json().alias("json")
    ).collect()
    assert [r["role"] for r in first] == ["click", "click"]
    assert first[0]["at"] == "2021-07-08 16:00:00"
    assert first[0]["hour"] == "2021-07-08--16"
    assert (
        first[0]["json"]
        == '{"eventType":"click","uid":"u1","timestamp":1625760000,"ip":"1.2.3.4","impressionId":"i1"}'
    )


def test_table_scan_is_pruned(spark):
    events = tables.click_events(spark, "/root/testdata/sf0.001")
    plan = events.groupBy("event_type").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan
    assert "PushedFilters: [In(event_type" in plan
    assert events.schema.fieldNames() == EVENT_SCHEMA.fieldNames()
    assert events.where(F.col("uid").isNull()).isEmpty()


def test_limits_say_what_the_job_waits_for(spark):
    with pytest.raises(ValueError, match="waits"):
        messages.kafka_records(spark, "localhost:1", records_per_batch=10)
