"""Sinks: hourly folders of log lines or Parquet, console, Kafka.

What a micro-batch writes into hourly folders stands in a folder of its own
below them (`bucket=.../batch=...`) and replaces what a failed attempt left. Rows
are brought together by hour first, so an hour gets one file from a micro-batch
unless it is large.
"""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clicksieve.functions.columns import event_json, event_line, hour_bucket
from clicksieve.schema import EVENT_COLUMNS
from clicksieve.sources.messages import FRAUD_TOPIC

# Fixed value: how often an output file is closed.
ROLL_INTERVAL = "15 minutes"
# Rows a file holds at most, about 1 GiB of log lines.
FILE_ROWS = 10_000_000


def triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """A trigger every `trigger`, or once over all that is available for None."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def log_lines(events: DataFrame) -> DataFrame:
    """Events as log lines with the hour (of event time) they belong to."""
    return events.select(event_line().alias("value"), hour_bucket().alias("bucket"))


def save_by_hour(rows: DataFrame, folder: str, batch_id: int, form: str, most_rows: int | None = None) -> None:
    """Rows with a `bucket` into hourly folders; a second call for a batch replaces the first."""
    if most_rows is not None and most_rows <= FILE_ROWS:
        # No hour is too large for a task; as many tasks as there is room for share the hours.
        dealt = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "bucket")
    else:
        # Adaptive execution splits an hour that is too large for a task and joins small ones.
        dealt = rows.hint("rebalance", F.col("bucket"))
    (
        dealt.withColumn("batch", F.lit(batch_id))
        .write.format(form)
        .partitionBy("bucket", "batch")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", FILE_ROWS)
        .mode("overwrite")
        .save(folder)
    )


def save_log(events: DataFrame, folder: str, batch_id: int = 0, most_rows: int | None = None) -> None:
    """A batch of events into hourly folders of log lines; of no more than `most_rows`, where that is known."""
    save_by_hour(log_lines(events), folder, batch_id, "text", most_rows)


def save_table(events: DataFrame, folder: str, batch_id: int = 0, most_rows: int | None = None) -> None:
    """A batch of events into hourly folders of Parquet."""
    save_by_hour(events.withColumn("bucket", hour_bucket()), folder, batch_id, "parquet", most_rows)


def save_batch(events: DataFrame, folder: str, batch_id: int = 0, most_rows: int | None = None) -> None:
    """A batch of events into one folder of Parquet of its own."""
    events.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def save_stream(events: DataFrame, save, folder: str, checkpoint: str, trigger: str | None) -> DataStreamWriter:
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        save(batch, folder, batch_id)

    return triggered(events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint), trigger)


write_log = partial(save_stream, save=save_log)
write_table = partial(save_stream, save=save_table)


def write_strings(strings: DataFrame, folder: str, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """The raw messages of a topic into text files."""
    writer = (
        strings.select("value")
        .writeStream.format("text")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, trigger)


def keep_counts(totals: DataFrame, name: str, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """Totals as a table `name` of the session, whole after every micro-batch. They have to fit the driver."""
    writer = totals.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger)


def print_counts(
    totals: DataFrame, checkpoint: str, trigger: str | None = None, rows: int = 2**31 - 1
) -> DataStreamWriter:
    """Changed totals on the console after every micro-batch, all of them unless `rows` says otherwise."""
    writer = (
        totals.writeStream.outputMode("update")
        .format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, trigger)


def fraud_messages(flagged: DataFrame) -> DataFrame:
    """Flagged clicks as JSON messages keyed by impression."""
    return flagged.select(F.col("impression_id").alias("key"), event_json().alias("value"))


def write_messages(
    flagged: DataFrame, servers: str, checkpoint: str, topic: str = FRAUD_TOPIC, trigger: str | None = None
) -> DataStreamWriter:
    """Flagged clicks to a Kafka topic, at least once. Needs the Kafka connector on the class path."""
    writer = (
        fraud_messages(flagged.select(*EVENT_COLUMNS))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, trigger)
