"""Windowed counts of a stream on Spark's state, with the rows that came too late counted as well.

Spark's own windowed aggregation drops late rows; here they have a count of their
own, so that the events of a stream are the counted and the late ones together.
A (window, type) is cut into `parts` by the arrival number: its rows are counted
in as many tasks, and readers add the parts up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clicksieve.functions.columns import event_time, grid_window
from clicksieve.schema import WINDOW_SECONDS
from clicksieve.streaming.commits import commit, last_commit, read_versions
from clicksieve.streaming.stateful import use_rocksdb

# Python workers get these classes by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How many tasks share the rows of one window and type.
PARTS = 16

COUNTED = T.StructType(
    [
        T.StructField("window", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_late", T.LongType()),
    ]
)
ROW = Row(*COUNTED.names)


class WindowCounter(StatefulProcessor):
    """Counts the rows of one (window, type, part) until the watermark has passed its end."""

    def __init__(self, window_seconds: int):
        self.window_seconds = window_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counted = handle.getValueState("counted", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = sum(1 for _ in rows)
        end = (key[0] + 1) * self.window_seconds * 1000
        if end <= timerValues.getCurrentWatermarkInMs():
            yield ROW(*key, None, new)
            return
        before = self.counted.get()
        if before is None:
            self.handle.registerTimer(end)
        n = new + (before[0] if before else 0)
        self.counted.update((n,))
        yield ROW(*key, n, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counted.clear()
        return iter(())

    def close(self) -> None:
        pass


def count_windows(events: DataFrame, delay_seconds: int, window_seconds: int = WINDOW_SECONDS, parts: int = PARTS) -> DataFrame:
    """window (its number), event_type, part, `n` so far or null, and how many rows came late in this micro-batch."""
    use_rocksdb(events.sparkSession)
    timed = events.withColumn("event_time", event_time()).withWatermark("event_time", f"{delay_seconds} seconds")
    # The time is left out again: late rows have to reach the counter.
    keyed = timed.select(
        grid_window(window_seconds).alias("window"),
        "event_type",
        F.pmod(F.xxhash64("seq"), F.lit(parts)).cast("int").alias("part"),
    )
    counter = WindowCounter(window_seconds)
    return keyed.groupBy("window", "event_type", "part").transformWithState(counter, COUNTED, "Append", "EventTime")


def write_counts(events: DataFrame, folder: str, delay_seconds: int, window_seconds: int = WINDOW_SECONDS) -> DataStreamWriter:
    """The windowed counts of a stream below a folder; windows are closed `delay_seconds` after their end."""
    spark = events.sparkSession

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id > last_commit(spark, folder):
            batch.write.mode("overwrite").parquet(f"{folder}/counts/batch={batch_id}")
            commit(spark, folder, batch_id)

    counted = count_windows(events, delay_seconds, window_seconds)
    return counted.writeStream.foreachBatch(one_batch).option("checkpointLocation", f"{folder}/checkpoint")


def read_counts(spark: SparkSession, folder: str, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """window_start (seconds), event_type, n counted in time and n_late counted too late."""
    rows = read_versions(spark, f"{folder}/counts", COUNTED, last_commit(spark, folder))
    # What a part has come to only grows.
    by_part = rows.groupBy("window", "event_type", "part").agg(F.max("n").alias("n"), F.sum("n_late").alias("n_late"))
    return by_part.groupBy("window", "event_type").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("n_late").alias("n_late")).select(
        (F.col("window") * window_seconds).alias("window_start"), "event_type", "n", "n_late"
    )
