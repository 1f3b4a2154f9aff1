"""The whole application: messages in, four logs and running totals out, and a report on an hour of them.

One query reads the source. Each micro-batch is written out once, and the log
of all events, the rejected messages, the detectors' logs and the totals are all
made from that, so they cover the same events however often it is restarted.
Readers see a micro-batch in all outputs or in none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicksieve.operators.counts import pattern_totals, type_totals
from clicksieve.plans.report import Detection, report_lines
from clicksieve.session import path_exists, remove_path
from clicksieve.sources.messages import Decoded
from clicksieve.sources.textlog import OUTPUTS
from clicksieve.streaming.commits import last_commit, read_versions
from clicksieve.streaming.detectors import PATTERNS, Arrival, Outputs, Rules, detect_stream, flush
from clicksieve.streaming.logs import FILE_BYTES, IDLE_SECONDS, compact, read_output
from clicksieve.streaming.sinks import ROLL_INTERVAL, save_log, triggered

TOTALS = "pattern string, event_type string, n long"
REJECTED = T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())])


def job_outputs(source: DataFrame | Decoded, folder: str) -> Outputs:
    """The four logs, the rejected messages and the totals below a folder."""
    decoded = isinstance(source, Decoded)

    def also(staged: DataFrame, batch_id: int) -> None:
        rejected = staged.where("not good").select("seq", "value")
        rejected.write.mode("overwrite").parquet(f"{folder}/rejected/batch={batch_id}")

    def totals(events: DataFrame, flagged: dict[str, DataFrame], batch_id: int, most_rows: int) -> None:
        save_log(events, f"{folder}/{OUTPUTS['all']}", batch_id, most_rows)
        add_totals(events, flagged, f"{folder}/totals", batch_id)

    logs = {pattern: f"{folder}/{OUTPUTS[pattern]}" for pattern in PATTERNS}
    return Outputs(logs, save_log, also if decoded else None, totals, "good" if decoded else None)


def run_job(
    source: DataFrame | Decoded,
    folder: str,
    rules: Rules | None = None,
    trigger: str | None = ROLL_INTERVAL,
    arrival: Arrival | None = None,
) -> StreamingQuery:
    """Start the query on a stream of events, or of decoded messages, and return it.

    With `trigger=None` it runs over what is available, takes the input as ended
    and has ended itself on return. Every micro-batch takes part in all outputs,
    so `trigger` is both how often detectors run and how often files are closed.
    With `arrival`, events wait until all partitions have passed their time; no
    output but the rejected messages has them before.
    """
    rows = source.parsed if isinstance(source, Decoded) else source
    rules, outputs, work = rules or Rules(), job_outputs(source, folder), f"{folder}/work"
    query = triggered(detect_stream(rows, work, outputs, rules, arrival), trigger).start()
    if trigger is None:
        query.awaitTermination()
        if arrival:
            like = rows.sparkSession.createDataFrame([], rows.schema)
            flush(like, work, outputs, rules, arrival)
    return query


def complete(spark: SparkSession, folder: str) -> int:
    """The last micro-batch that all outputs have; readers see nothing after it."""
    return last_commit(spark, f"{folder}/work")


def add_totals(events: DataFrame, flagged: dict[str, DataFrame], folder: str, batch_id: int) -> None:
    """Write the totals up to and including a micro-batch; those before the last but one go."""
    spark = events.sparkSession
    none = F.lit(None).cast("string")
    labelled = [f.withColumn("pattern", F.lit(p)) for p, f in flagged.items()]
    now = type_totals(events).select(none.alias("pattern"), "event_type", "n")
    for one in labelled:
        now = now.unionByName(pattern_totals(one).select("pattern", "event_type", "n"))
    if batch_id > 0:
        now = now.unionByName(spark.read.schema(TOTALS).parquet(f"{folder}/batch={batch_id - 1}"))
    whole = now.groupBy("pattern", "event_type").agg(F.sum("n").alias("n"))
    whole.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    remove_path(spark, f"{folder}/batch={batch_id - 2}")


def read_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The totals so far: events per type, and flagged clicks per pattern and type."""
    path = f"{folder}/totals/batch={complete(spark, folder)}"
    return spark.read.schema(TOTALS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], TOTALS)


def read_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """The messages that are no events, as they came."""
    path = f"{folder}/rejected"
    schema = spark.read.parquet(path).drop("batch").schema if path_exists(spark, path) else REJECTED
    return read_versions(spark, path, schema, complete(spark, folder))


def read_log(spark: SparkSession, folder: str, output: str, bucket: str | None = None) -> DataFrame:
    """The events of an output (`all` or a pattern), or of one hour of it."""
    return read_output(spark, folder, output, complete(spark, folder), bucket).events


def compact_logs(
    spark: SparkSession, folder: str, before: str | None = None, file_bytes: int = FILE_BYTES, idle_seconds: float = IDLE_SECONDS
) -> dict[tuple[str, str], int]:
    """Bring the logs of closed hours, those before bucket `before` or idle ones, into few files; see `streaming.logs`."""
    return compact(spark, folder, before, complete(spark, folder), file_bytes, idle_seconds)


def hour_report(spark: SparkSession, folder: str, bucket: str) -> DataFrame:
    """The report on one hour of the outputs, e.g. bucket 2021-07-08--16, as of one micro-batch for all of them."""
    last = complete(spark, folder)
    events, *flagged = (read_output(spark, folder, output, last, bucket).events for output in ("all", *PATTERNS))
    return report_lines(Detection(events, *flagged))
