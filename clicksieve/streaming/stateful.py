"""The documented detectors on Spark's own state.

Every event goes to its user, impression and address in one exchange, by
(pattern, key). Of each key the state store holds a map from window to what the
window has come to, and, for patterns whose keys stay suspicious, the first
flagged arrival. Within a micro-batch the rows of a key are taken in order of
`seq`; a later micro-batch counts as later arrival.

With a delay, a window is forgotten `delay_seconds` after its end: its timer
removes it when the watermark passes, and rows that come for it afterwards are
not judged but returned as late ones, so none is lost without a trace. Without,
windows are kept for ever and no row is late.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clicksieve.functions.columns import event_time
from clicksieve.schema import DISPLAY, ORDERED_COLUMNS, PATTERN_1, PATTERN_2, PATTERN_3

# Python workers get these classes by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = {PATTERN_1: "uid", PATTERN_2: "impression_id", PATTERN_3: "ip"}
STICKY = (PATTERN_1, PATTERN_3)

# Names of the state variables in a checkpoint.
WINDOWS, SUSPICIOUS = "windows", "suspicious"
NUMBERS = T.StructType([T.StructField("n1", T.LongType()), T.StructField("n2", T.LongType())])
WINDOW = T.StructType([T.StructField("window", T.LongType())])

JUDGED = Row(*ORDERED_COLUMNS, "pattern", "late")

Numbers = tuple[int | None, int | None]


@dataclass
class PendingDisplays:
    """Pattern 1: a click is a hit when no display of the user is left in the window."""

    def judge(self, numbers: Numbers, display: bool, timestamp: int) -> tuple[Numbers, bool]:
        pending = (numbers[0] or 0) + (1 if display else -1)
        return (pending, None), not display and pending < 0


@dataclass
class QuickClicks:
    """Pattern 2: a click is a hit when it is close to the last display of the impression."""

    threshold_seconds: int

    def judge(self, numbers: Numbers, display: bool, timestamp: int) -> tuple[Numbers, bool]:
        shown = timestamp if display else numbers[0]
        return (shown, None), not display and shown is not None and 0 <= timestamp - shown < self.threshold_seconds


@dataclass
class HyperactiveAddresses:
    """Pattern 3: a click is a hit when the address has many clicks, and many for its displays."""

    min_clicks: int
    min_ctr: float
    # Whether the ratio is rounded down to a whole number.
    whole: bool

    def judge(self, numbers: Numbers, display: bool, timestamp: int) -> tuple[Numbers, bool]:
        clicks, displays = (numbers[0] or 0) + (not display), (numbers[1] or 0) + display
        if display or clicks < self.min_clicks or not displays:
            return (clicks, displays), False
        return (clicks, displays), (clicks // displays if self.whole else clicks / displays) >= self.min_ctr


def processors(rules) -> dict[str, PendingDisplays | QuickClicks | HyperactiveAddresses]:
    return {
        PATTERN_1: PendingDisplays(),
        PATTERN_2: QuickClicks(rules.threshold_seconds),
        PATTERN_3: HyperactiveAddresses(rules.min_clicks, rules.min_ctr, rules.semantics == "separate_int"),
    }


class Detector(StatefulProcessor):
    """Judges the events of one (pattern, key)."""

    def __init__(self, rules, seq_type: T.DataType):
        self.judges, self.window_seconds = processors(rules), rules.window_seconds
        self.forgets, self.seq_type = rules.delay_seconds is not None, seq_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState(WINDOWS, WINDOW, NUMBERS)
        self.suspicious = handle.getValueState(SUSPICIOUS, T.StructType([T.StructField("first_seq", self.seq_type)]))

    def end_millis(self, window: int) -> int:
        return (window + 1) * self.window_seconds * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pattern = key[0]
        judge, sticky = self.judges[pattern].judge, pattern in STICKY
        suspicious = sticky and self.suspicious.get() is not None
        watermark = timerValues.getCurrentWatermarkInMs() if self.forgets else None
        seen: dict[int, Numbers] = {}
        for row in sorted(rows, key=lambda r: r["seq"]):
            window = row["timestamp"] // self.window_seconds
            if watermark is not None and self.end_millis(window) <= watermark:
                yield JUDGED(*row[: len(ORDERED_COLUMNS)], pattern, True)
                continue
            if window not in seen:
                before = self.windows.getValue((window,))
                if before is None and self.forgets:
                    self.handle.registerTimer(self.end_millis(window))
                seen[window] = before or (None, None)
            display = row["event_type"] == DISPLAY
            seen[window], hit = judge(seen[window], display, row["timestamp"])
            if hit and sticky and not suspicious:
                suspicious = True
                self.suspicious.update((row["seq"],))
            if hit or suspicious and not display:
                yield JUDGED(*row[: len(ORDERED_COLUMNS)], pattern, False)
        for window, numbers in seen.items():
            self.windows.updateValue((window,), numbers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        window = expiredTimerInfo.getExpiryTimeInMs() // 1000 // self.window_seconds - 1
        self.windows.removeKey((window,))
        return iter(())

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State with several variables and timers needs this store."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def judge_stream(events: DataFrame, rules, patterns: tuple[str, ...] = tuple(KEYS)) -> DataFrame:
    """Flagged clicks of a stream with their `pattern`, and events that came too late to be judged as `late` ones."""
    use_rocksdb(events.sparkSession)
    if rules.delay_seconds is not None:
        # The time itself is left out below: late rows have to reach the detectors, which know whose window is over.
        events = events.withColumn("event_time", event_time()).withWatermark("event_time", f"{rules.delay_seconds} seconds")
    keyed = events.select(*ORDERED_COLUMNS, F.inline(F.array(*[F.struct(F.lit(p).alias("pattern"), _key(p)) for p in patterns])))
    fields = [keyed.schema[c] for c in ORDERED_COLUMNS]
    output = T.StructType([*fields, T.StructField("pattern", T.StringType()), T.StructField("late", T.BooleanType())])
    return keyed.groupBy("pattern", "key").transformWithState(
        Detector(rules, events.schema["seq"].dataType), output, "Append", "None" if rules.delay_seconds is None else "EventTime"
    )


def _key(pattern: str) -> Column:
    return F.col(KEYS[pattern]).alias("key")


def blacklist(spark: SparkSession, checkpoint: str, pattern: str, batch_id: int | None = None) -> DataFrame:
    """key and first_seq of all that are suspicious for good, read from the state of a stopped or running query."""
    reader = spark.read.format("statestore").option("stateVarName", SUSPICIOUS)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    return state.where(F.col("key.pattern") == pattern).select("key.key", F.col("value.first_seq").alias("first_seq"))
