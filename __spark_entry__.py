"""

Every query runs over the whole `events` table of the given folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from clicksieve.functions.columns import event_json, event_line, hour_bucket, role, utc_time
from clicksieve.operators import counts, detectors
from clicksieve.operators.boundaries import window_boundaries
from clicksieve.plans import job, report
from clicksieve.schema import CLICK, DISPLAY, EVENT_COLUMNS, ORDERED_COLUMNS, PATTERN_1, PATTERN_2, PATTERN_3
from clicksieve.session import new_run_folder
from clicksieve.sources import messages
from clicksieve.sources.messages import decode
from clicksieve.sources.tables import click_events
from clicksieve.sources.textlog import parse_lines, read_bucket, read_log
from clicksieve.streaming import sinks, stateful
from clicksieve.streaming.commits import commit
from clicksieve.streaming.detectors import Arrival, Outputs, Rules, detect_stream, flush, read_late
from clicksieve.streaming.replay import even_cuts, finish, flagged_table, in_pieces, replay
from clicksieve.streaming.windows import read_counts, write_counts

# The text operators may be left out as a whole; anything else missing is an error.
try:
    from clicksieve.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name != "clicksieve.llm":
        raise
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "clicksieve.llm"):
        raise
    corpus_pipeline = None

# The windows and thresholds at which the sparse test events give results for
# the documented rules.
WINDOW = 7 * 86400
THRESHOLD = 12 * 3600
# The window at which the two readings of pattern 3 differ.
IP_WINDOW = 30 * 86400
# How late events of a stream may come, where windows are closed.
DELAY = 5 * 86400
# A limit so low that keys of the test events are split.
SPLIT_ROWS = 20


def entry(spark: SparkSession) -> DataFrame:
    """Click-through rate after fraud, on the smallest tables."""
    return queries()["ctr_after_fraud"](spark, "/root/testdata/sf0.001")


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = click_events(spark, sf_dir).select("seq", event_json().alias("value"))
    return decode(messages).events


def damaged_messages(events: DataFrame) -> DataFrame:
    """Events as messages; those of errors are no JSON, have a wrong type, or lack a field, in turn."""
    text = event_json()
    damaged = (
        F.when(F.col("seq") % 3 == 0, F.concat(F.lit("error: "), text))
        .when(F.col("seq") % 3 == 1, F.regexp_replace(text, r'"timestamp":(\d+)', '"timestamp":"$1"'))
        .otherwise(F.regexp_replace(text, r'"uid":"[^"]*",', ""))
    )
    return events.select("seq", F.when(F.col("event_type") == "error", damaged).otherwise(text).alias("value"))


def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(damaged_messages(click_events(spark, sf_dir, keep_other_types=True)))
    return decoded.parsed.agg(
        F.count_if("good").alias("decoded"), F.count_if(~F.col("good")).alias("rejected")
    )


def kafka_records(events: DataFrame) -> DataFrame:
    """Events laid out as the records of two topics of four partitions."""
    return events.select(
        F.when(F.col("event_type") == DISPLAY, "displays").otherwise("clicks").alias("topic"),
        F.pmod(F.col("uid").cast("int"), F.lit(4)).alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
        F.col("uid").cast("binary").alias("key"),
        event_json().cast("binary").alias("value"),
    )


def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = messages.record_events(kafka_records(click_events(spark, sf_dir))).events
    return events.withColumn("seq", F.col("seq").cast("string"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_folder(spark, "json")
    click_events(spark, sf_dir).select(event_json()).write.text(folder)
    return messages.named_topic(messages.json_line_events(spark, folder).events)


def log_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hour of the log, read back from its folder."""
    folder = new_run_folder(spark, "log")
    events = click_events(spark, sf_dir)
    sinks.save_log(events, f"{folder}/all")
    return read_bucket(spark, folder, "all", events.agg(F.min(hour_bucket())).first()[0]).events


def log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through the log sink of a stream, three micro-batches, read back."""
    folder = new_run_folder(spark, "sink")
    for stream in in_pieces(click_events(spark, sf_dir), f"{folder}/in"):
        finish(sinks.write_log(stream, folder=f"{folder}/all", checkpoint=f"{folder}/checkpoint", trigger=None))
    return read_log(spark, f"{folder}/all").events


def raw_to_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of one topic through a stream into text files, read back."""
    folder = new_run_folder(spark, "raw")
    for stream in in_pieces(click_events(spark, sf_dir), f"{folder}/in"):
        strings = messages.topic_strings(kafka_records(stream), "clicks")
        finish(sinks.write_strings(strings, f"{folder}/clicks", f"{folder}/checkpoint"))
    return spark.read.schema("value string").text(f"{folder}/clicks")


def window_starts(counted: DataFrame) -> DataFrame:
    return counted.withColumn("window_start", utc_time(F.unix_seconds("window_start")))


def tumbling_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts of a stream in update mode, the last count of each window."""
    folder = new_run_folder(spark, "tumbling")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    for stream in in_pieces(click_events(spark, sf_dir), f"{folder}/in"):
        # Events of this table come in no order of time: none is late.
        counted = counts.tumbling_counts(stream, delay="100000 days")
        finish(counted.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{folder}/checkpoint"))
    rows = spark.read.parquet(f"{folder}/out").groupBy("window_start", "event_type")
    return window_starts(rows.agg(F.max_by("n", "batch").alias("n")))


def blacklist_stream(pattern: str, window_seconds: int) -> Callable[[SparkSession, str], DataFrame]:
    """Who is suspicious for good, read from the state that a stream has left in its checkpoint."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_run_folder(spark, "blacklist")
        outputs = Outputs({pattern: f"{folder}/out"}, sinks.save_batch)
        for stream in in_pieces(click_events(spark, sf_dir), f"{folder}/in"):
            finish(detect_stream(stream, folder, outputs, Rules("documented", window_seconds)))
        found = stateful.blacklist(spark, f"{folder}/checkpoint", pattern)
        return found.withColumnRenamed("key", stateful.KEYS[pattern])

    return query


def late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern 1 on a stream that forgets windows: what it flags, and what came too late to be judged."""
    folder, events = new_run_folder(spark, "late"), click_events(spark, sf_dir)
    outputs = Outputs({PATTERN_1: f"{folder}/out"}, sinks.save_batch)
    for stream in in_pieces(events, f"{folder}/in", cuts=even_cuts(events)):
        finish(detect_stream(stream, folder, outputs, Rules("documented", WINDOW, delay_seconds=DELAY)))
    flagged = flagged_table(spark, f"{folder}/out").select("seq", F.lit("flagged").alias("verdict"))
    return flagged.unionByName(read_late(spark, folder).select("seq", F.lit("late").alias("verdict")))


def tumbling_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts of a stream, and of its late events."""
    folder, events = new_run_folder(spark, "windows"), click_events(spark, sf_dir)
    for stream in in_pieces(events, f"{folder}/in", cuts=even_cuts(events)):
        finish(write_counts(stream, folder, DELAY))
    return read_counts(spark, folder).withColumn("window_start", utc_time(F.col("window_start")))


def totals_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running totals of a stream, from the table that the session can query."""
    folder = new_run_folder(spark, "totals")
    name = f"totals_{folder.rsplit('-', 1)[-1]}"
    for stream in in_pieces(click_events(spark, sf_dir), f"{folder}/in"):
        finish(sinks.keep_counts(counts.type_totals(stream), name, f"{folder}/checkpoint"))
    return spark.table(name)


def log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of several micro-batches after compaction of its hours, the last micro-batch not being complete."""
    folder, events = new_run_folder(spark, "compacted"), click_events(spark, sf_dir)
    cuts, seq = even_cuts(events), F.col("seq")
    pieces = [events.where((seq >= low) & (seq < high)) for low, high in pairwise([0, *cuts, 1 << 62])]
    for batch_id, piece in enumerate([*pieces, events]):
        sinks.save_log(piece, f"{folder}/all", batch_id, 0)
        if batch_id < len(pieces):
            commit(spark, f"{folder}/work", batch_id)
    job.compact_logs(spark, folder, before=events.agg(F.max(hour_bucket())).first()[0] or "")
    return job.read_log(spark, folder, "all")


def held_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern 1 on records of eight partitions of which half run ahead of the others until the input ends."""
    folder, arrival = new_run_folder(spark, "held"), Arrival(8, None)
    # The broker's time is the order of arrival.
    records = kafka_records(click_events(spark, sf_dir)).withColumn("timestamp", F.timestamp_millis("offset"))
    span = records.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
    third = F.floor(3 * (F.col("offset") - (span["low"] or 0)) / ((span["high"] or 0) - (span["low"] or 0) + 1))
    piece = third + F.col("partition") % 2
    outputs, rules = Outputs({PATTERN_1: f"{folder}/out"}, sinks.save_batch, good="good"), Rules()
    for i in range(4):
        records.where(piece == i).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(records.schema).parquet(f"{folder}/in")
        parsed = messages.record_events(stream).parsed
        finish(detect_stream(parsed, folder, outputs, rules, arrival))
    flush(spark.createDataFrame([], parsed.schema), folder, outputs, rules, arrival)
    found = spark.read.parquet(f"{folder}/out")
    return found.select((F.col("seq") % 10**18).cast("long").alias("seq"), *EVENT_COLUMNS)


def job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of the whole application, run over all messages in three micro-batches."""
    folder = new_run_folder(spark, "job")
    events = click_events(spark, sf_dir, keep_other_types=True)
    for stream in in_pieces(events, f"{folder}/in"):
        job.run_job(decode(damaged_messages(stream)), f"{folder}/out", trigger=None)
    rejected = job.read_rejected(spark, f"{folder}/out").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    return job.read_totals(spark, f"{folder}/out").unionByName(
        rejected.select(none.alias("pattern"), F.lit("rejected").alias("event_type"), "n")
    )


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = click_events(spark, sf_dir).select("seq", event_line().alias("value"))
    return parse_lines(lines, keep=("seq",)).events


def hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_events(spark, sf_dir).groupBy(hour_bucket().alias("bucket")).agg(F.count("*").alias("n"))


def pattern_running(spark: SparkSession, sf_dir: str, group_rows: int | None = None) -> DataFrame:
    events = click_events(spark, sf_dir)
    found = report.detect(events)
    labelled = found.labelled().select("seq", "pattern", "event_type", F.coalesce("copy", F.lit(1)).alias("copy"))
    return counts.running_pattern_counts(labelled, events, found.counted["n"], group_rows)


def ctr_after_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = click_events(spark, sf_dir)
    after = report.ctr_after_fraud(report.detect(events))
    return after.select("n_displays", "n_clicks", "n_invalid", "ctr")


def report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_numbers(report.detect(click_events(spark, sf_dir)))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_lines(report.detect(click_events(spark, sf_dir)))


def fraud_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = report.detect(click_events(spark, sf_dir)).labelled()
    return flagged.select(*ORDERED_COLUMNS).distinct().select("seq", event_json().alias("value"))


def on_stream(pattern: str, **rules) -> Callable[[SparkSession, str], DataFrame]:
    """A detector run as a streaming query over the events."""
    return lambda spark, sf_dir: replay(spark, sf_dir, (pattern,), **rules).drop("pattern")


def on_events(query: Callable[..., DataFrame], **settings) -> Callable[[SparkSession, str], DataFrame]:
    """A query that takes the click events and nothing else."""
    return lambda spark, sf_dir: query(click_events(spark, sf_dir), **settings)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    p1, p2, p3 = detectors.clicks_without_display, detectors.quick_clicks, detectors.hyperactive_ips
    documented = {"semantics": "documented", "window_seconds": WINDOW}
    by_address = {"semantics": "documented", "window_seconds": IP_WINDOW}
    by_name = {
        "project_event": on_events(lambda ev: ev.select(*ORDERED_COLUMNS)),
        "filter_clicks": on_events(lambda ev: ev.where(F.col("event_type") == CLICK).select(*ORDERED_COLUMNS)),
        "split_types": lambda spark, sf_dir: click_events(spark, sf_dir, keep_other_types=True)
        .groupBy(role().alias("role"))
        .agg(F.count("*").alias("n")),
        "event_time": on_events(
            lambda ev: ev.select("seq", utc_time(F.col("timestamp")).alias("event_time"))
        ),
        "json_decode": json_decode,
        "json_malformed": json_malformed,
        "event_to_text": on_events(lambda ev: ev.select("seq", event_line().alias("line"))),
        "log_parse": log_parse,
        "window_boundaries": on_events(window_boundaries),
        "key_segments": on_events(detectors.key_segments),
        "p1_as_coded": on_events(p1),
        "p2_as_coded": on_events(p2),
        "p3_as_coded": on_events(p3),
        "p1_documented": on_events(p1, **documented),
        "p2_documented": on_events(p2, threshold_seconds=THRESHOLD, **documented),
        "p3_documented": on_events(p3, **by_address),
        "p3_separate_int": on_events(p3, semantics="separate_int", window_seconds=IP_WINDOW),
        "p1_as_coded_split": on_events(p1, group_rows=SPLIT_ROWS),
        "p2_as_coded_split": on_events(p2, group_rows=1),
        "p3_as_coded_split": on_events(p3, group_rows=SPLIT_ROWS),
        "p1_documented_split": on_events(p1, group_rows=SPLIT_ROWS, **documented),
        "p3_documented_split": on_events(p3, group_rows=SPLIT_ROWS, **by_address),
        "blacklist_uid": on_events(lambda ev: detectors.first_flagged(p1(ev), "uid")),
        "blacklist_ip": on_events(lambda ev: detectors.first_flagged(p3(ev), "ip")),
        "running_counts": on_events(counts.running_counts),
        "running_counts_split": on_events(counts.running_counts, group_rows=SPLIT_ROWS),
        "type_totals": on_events(counts.type_totals),
        "pattern_totals": on_events(lambda ev: counts.pattern_totals(report.detect(ev).labelled())),
        "pattern_running": pattern_running,
        "pattern_running_split": partial(pattern_running, group_rows=SPLIT_ROWS),
        "tumbling_counts": on_events(lambda ev: window_starts(counts.tumbling_counts(ev))),
        "tumbling_counts_stream": tumbling_counts_stream,
        "fraud_union_all": on_events(lambda ev: report.detect(ev).union_all()),
        "fraud_distinct": on_events(lambda ev: report.detect(ev).distinct()),
        "ctr": on_events(report.ctr),
        "ctr_after_fraud": ctr_after_fraud,
        "report_lines": report_lines,
        "hour_bucket": hour_counts,
        "fraud_json": fraud_json,
        "p1_documented_stream": on_stream(PATTERN_1, **documented),
        "p2_documented_stream": on_stream(PATTERN_2, threshold_seconds=THRESHOLD, **documented),
        "p3_documented_stream": on_stream(PATTERN_3, **by_address),
        "as_coded_stream": lambda spark, sf_dir: replay(spark, sf_dir).select("pattern", *ORDERED_COLUMNS),
        "kafka_frame": kafka_frame,
        "topic_strings": on_events(lambda ev: messages.topic_strings(kafka_records(ev), "clicks")),
        "record_lines": on_events(lambda ev: messages.record_lines(kafka_records(ev))),
        "json_lines": json_lines,
        "log_hour": log_hour,
        "log_sink": log_sink,
        "raw_to_files": raw_to_files,
        "job_totals": job_totals,
        "blacklist_uid_stream": blacklist_stream(PATTERN_1, WINDOW),
        "blacklist_ip_stream": blacklist_stream(PATTERN_3, IP_WINDOW),
        "p1_late_stream": late_stream,
        "tumbling_late_stream": tumbling_late_stream,
        "totals_table": totals_table,
        "log_compacted": log_compacted,
        "p1_held_stream": held_stream,
        "report_numbers": report_numbers,
    }
    if llm:
        by_name |= llm.queries()
    if corpus_pipeline:
        by_name["pipeline"] = corpus_pipeline.run
    return by_name


def oracle_sql() -> dict[str, str]:
    found = oracle.oracle_sql(WINDOW, THRESHOLD, IP_WINDOW, DELAY)
    if llm:
        found |= llm.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
