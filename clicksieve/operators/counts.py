"""Counts of events and of flagged clicks. All but the running ones also work on streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.columns import event_time
from clicksieve.operators.running import running_sums
from clicksieve.operators.skew import split_all_keys, split_hot_keys
from clicksieve.schema import PATTERN_1, PATTERN_2, PATTERN_3


def type_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def running_counts(events: DataFrame, total_rows: int | None = None, group_rows: int | None = None) -> DataFrame:
    """For every event, how many of its type have arrived so far."""
    split = split_hot_keys(events.select("seq", "event_type"), ["event_type"], total_rows, group_rows)
    counted = running_sums(split, ["event_type"], {"n": F.lit(1).cast("long")})
    return counted.select("seq", "event_type", "n")


def label_patterns(p1: DataFrame, p2: DataFrame, p3: DataFrame) -> DataFrame:
    """The flagged clicks of the three detectors with the label of the detector."""
    labelled = p1.withColumn("pattern", F.lit(PATTERN_1))
    for label, flagged in [(PATTERN_2, p2), (PATTERN_3, p3)]:
        labelled = labelled.unionByName(flagged.withColumn("pattern", F.lit(label)), allowMissingColumns=True)
    return labelled


def pattern_totals(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("event_type", "pattern").agg(F.count("*").alias("n"))


def running_pattern_counts(
    labelled: DataFrame, events: DataFrame, n_events: int, group_rows: int | None = None
) -> DataFrame:
    """For every flagged click, how many of its type its detector has flagged so far.

    `labelled` has seq, pattern, event_type and copy; `events` are those it was found in.
    """
    # No more than two emissions from the third detector and one from each other.
    split = split_all_keys(labelled, events, n_events, 4 * n_events, group_rows)
    counted = running_sums(
        split, ["pattern", "event_type"], {"n": F.lit(1).cast("long")}, order=("seq", "copy")
    )
    return counted.select("seq", "pattern", "event_type", "n")


def tumbling_counts(events: DataFrame, window: str = "30 minutes", delay: str = "30 minutes") -> DataFrame:
    """Events per type and window of event time; the delay is the watermark of a stream."""
    return (
        events.select("event_type", event_time().alias("event_time"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "event_type")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n")
    )
