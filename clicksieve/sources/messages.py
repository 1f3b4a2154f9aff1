"""JSON messages: decoding, Kafka topics and JSON-line files."""

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.functions.columns import has_time
from clicksieve.schema import EVENT_COLUMNS, JSON_FIELDS, JSON_SCHEMA

# Topic names.
TOPICS = ("clicks", "displays")
FRAUD_TOPIC = "fraud_clicks"

UNSAID = object()


@dataclass
class Decoded:
    """Parsed rows: the five fields, what was kept, the text as `value`, and whether it is `good`."""

    parsed: DataFrame
    keep: tuple[str, ...]

    @property
    def events(self) -> DataFrame:
        return self.parsed.where("good").select(*self.keep, *EVENT_COLUMNS)

    @property
    def rejected(self) -> DataFrame:
        return self.parsed.where("not good").select(*self.keep, "value")


def decode(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ("seq",)) -> Decoded:
    """Parse messages once; events and rejected rows are told apart by a flag.

    Rejected is what does not parse, has a value of the wrong type, lacks one of
    the five fields, or has seconds that are no time between the years 1 and
    9999. Works alike on batch and streaming frames; results keep the columns
    named in `keep`.
    """
    schema = T.StructType([*JSON_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    # A generator keeps Spark from parsing anew for every use of a field.
    parsed = messages.select(*keep, text.alias("_text")).select(
        *keep, "_text", F.inline(F.array(F.from_json("_text", schema, options)))
    )
    good = F.col("_corrupt").isNull() & F.coalesce(has_time(), F.lit(False))
    for name in JSON_FIELDS:
        good = good & F.col(name).isNotNull()
    fields = [F.col(name).alias(column) for name, column in JSON_FIELDS.items()]
    return Decoded(parsed.select(*keep, *fields, F.col("_text").alias("value"), good.alias("good")), keep)


def arrival_order(topics: tuple[str, ...] = TOPICS) -> Column:
    """One sortable number from a Kafka record's timestamp, topic, partition and offset.

    Fourteen digits of milliseconds, one for the topic (its place in `topics`,
    of which there are nine at most), five of partition, eighteen of offset.
    Records of other topics have no number.
    """
    if len(topics) > 9:
        raise ValueError("no more than nine topics")
    place = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic"))
    topic = F.when(place > 0, place).cast("decimal(38,0)")

    def times(number: Column, digits: int) -> Column:
        return number * F.lit(Decimal(10**digits)).cast(f"decimal({digits + 1},0)")

    millis = F.unix_millis(F.col("timestamp").cast("timestamp")).cast("decimal(14,0)")
    seq = times(millis, 24) + times(topic.cast("decimal(1,0)"), 23) + times(F.col("partition").cast("decimal(5,0)"), 18)
    return (seq + F.col("offset").cast("decimal(18,0)")).cast("decimal(38,0)")


def record_millis(seq: str) -> Column:
    """The record time in a number of `arrival_order`."""
    return F.substring(F.lpad(F.col(seq).cast("decimal(38,0)").cast("string"), 38, "0"), 1, 14).cast("long")


def record_place(seq: str) -> Column:
    """Topic and partition in a number of `arrival_order`."""
    digits = F.lpad(F.col(seq).cast("decimal(38,0)").cast("string"), 38, "0")
    return F.substring(digits, 15, 6)


def kafka_records(
    spark: SparkSession,
    servers: str,
    topics: tuple[str, ...] = TOPICS,
    starting_offsets: str = "latest",
    records_per_batch: int | None = None,
    waits: object = UNSAID,
    **options: str,
) -> DataFrame:
    """The topics as one stream of Kafka records. Needs the Kafka connector on the class path.

    Without `records_per_batch` a backlog is one micro-batch, in order of record
    time. With it, micro-batches are not, and what is flagged depends on it unless
    rows wait for all partitions. So `waits` has to be given with it: the
    `streaming.detectors.Arrival` that the job is run with, or None where
    the order does not matter.
    """
    if records_per_batch is not None:
        if waits is UNSAID:
            raise ValueError("records_per_batch needs `waits`, the Arrival that the job is run with, or None")
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def record_events(records: DataFrame, topics: tuple[str, ...] = TOPICS) -> Decoded:
    """Events of Kafka records, in arrival order."""
    return decode(records.select(arrival_order(topics).alias("seq"), "value"))


def topic_strings(records: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic as text."""
    return records.where(F.col("topic") == topic).select(F.col("value").cast("string").alias("value"))


def record_lines(records: DataFrame) -> DataFrame:
    """One line per record that shows offset, key and value."""
    return records.select(
        # Fixed value: the format of a record's line.
        F.format_string(
            "offset = %d, key = %s, value = %s",
            F.col("offset"),
            F.col("key").cast("string"),
            F.col("value").cast("string"),
        ).alias("line")
    )


def json_line_events(spark: SparkSession, path: str) -> Decoded:
    """Events from JSON-line files, and the lines that are none."""
    return decode(spark.read.text(path), keep=())


def named_topic(events: DataFrame) -> DataFrame:
    """Events as the reader of JSON lines shows them: the event type is named `topic`."""
    return events.withColumnRenamed("event_type", "topic")
