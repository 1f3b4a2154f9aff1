"""Whole tables run through the streaming detectors, with the result as a table."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clicksieve.operators.skew import cut_points
from clicksieve.schema import EVENT_SCHEMA, ORDERED_COLUMNS
from clicksieve.session import new_run_folder
from clicksieve.sources.tables import click_events
from clicksieve.streaming.detectors import PATTERNS, Outputs, Rules, detect_stream
from clicksieve.streaming.sinks import save_batch

# Micro-batches that a replay takes.
PIECES = 3


def in_pieces(events: DataFrame, folder: str, pieces: int = PIECES, cuts: list[int] | None = None) -> Iterator[DataFrame]:
    """The events as a stream that grows piece by piece, in arrival order.

    Each time the stream is handed out one more piece has come; a query that is
    run over it then, from its checkpoint, takes the piece as one micro-batch.
    The pieces are about equal, or cut at the given numbers.
    """
    cuts = cut_points(events, pieces, events.count()) if cuts is None else cuts
    seq = F.col("seq")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        piece = events if low is None else events.where(seq >= low)
        piece = piece if high is None else piece.where(seq < high)
        piece.select(*ORDERED_COLUMNS).write.mode("append").parquet(folder)
        yield events.sparkSession.readStream.schema(EVENT_SCHEMA).parquet(folder)


def even_cuts(events: DataFrame, pieces: int = PIECES) -> list[int]:
    """Numbers that cut the span of arrival numbers evenly, the same in every run."""
    span = events.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).first()
    if span["low"] is None:
        return []
    return [span["low"] + (span["high"] - span["low"]) * i // pieces for i in range(1, pieces)]


def flagged_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(folder).select(*ORDERED_COLUMNS)


def finish(writer: DataStreamWriter) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def replay(spark: SparkSession, sf_dir: str, patterns: tuple[str, ...] = tuple(PATTERNS), **rules) -> DataFrame:
    """Flagged clicks of detectors with the label of the detector."""
    work = new_run_folder(spark, "replay")
    outputs = {pattern: f"{work}/{pattern.replace(' ', '_')}" for pattern in patterns}
    for stream in in_pieces(click_events(spark, sf_dir), f"{work}/in"):
        finish(detect_stream(stream, work, Outputs(outputs, save_batch), Rules(**rules)))
    tables = [flagged_table(spark, folder).withColumn("pattern", F.lit(p)) for p, folder in outputs.items()]
    found = tables[0]
    for table in tables[1:]:
        found = found.unionByName(table)
    return found
