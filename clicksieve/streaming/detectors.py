"""The detectors on streams: one query reads the source and feeds all outputs.

The documented rules run on Spark's own state, see `stateful`. The window of
`as_coded` is shared by all keys and opened by an event, which no state of a key
can tell; its state is carried from micro-batch to micro-batch in tables.

There, every micro-batch is written out once and then judged by the code of the
batch detectors: what a key brings along (running numbers of its windows, and whether
it is suspicious for good) goes in front of its events as a row of its own. What
the micro-batch has changed is appended to a state table; readers take the
latest version of each key. When the appended versions outgrow the last
snapshot, a new snapshot is written, so the effort is in proportion to the keys
touched, and what is no longer needed is removed.

Within a micro-batch events are taken in order of `seq`; a later micro-batch
counts as later arrival. Large keys of a micro-batch are split as in batch runs.
Where `Arrival` says how many partitions the source has, rows wait in a table
until each of them has passed their record time, so that limits on micro-batches
change no result. A partition that has brought nothing for some time is waited
for no longer, and `flush` takes all rows that still wait when input has ended.

What waits no longer is a step of its own; steps and not the micro-batches of the
source are numbered in outputs. A step is complete once its mark is written, and
readers see it once it is committed. One that failed is repeated from the start: everything it writes
replaces what the failed attempt left. A micro-batch whose predecessor has no
mark raises, as its state is unknown.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clicksieve.functions.columns import grid_window
from clicksieve.operators.boundaries import boundary_lookup, mark_boundaries
from clicksieve.operators.detectors import emissions, judge_hyperactive, judge_pending, judge_quick, since_suspicious
from clicksieve.operators.skew import Split, split_hot_keys
from clicksieve.schema import (
    DISPLAY,
    EVENT_SCHEMA,
    MIN_CLICKS,
    MIN_CTR,
    ORDERED_COLUMNS,
    PATTERN_1,
    PATTERN_2,
    PATTERN_3,
    QUICK_SECONDS,
    WINDOW_SECONDS,
)
from clicksieve.session import names_in, path_exists, remove_path, touch
from clicksieve.sources.messages import record_millis, record_place
from clicksieve.streaming.commits import commit, last_commit, read_versions
from clicksieve.streaming.sinks import save_table
from clicksieve.streaming.stateful import KEYS as PATTERNS
from clicksieve.streaming.stateful import judge_stream

READINGS = {PATTERN_1: ("as_coded", "documented"), PATTERN_2: ("as_coded", "documented"), PATTERN_3: ("as_coded", "documented", "separate_int")}

# Rows that a click can be emitted as.
MOST_EMISSIONS = 2
# The window of the row that says its key is suspicious for good.
KNOWN = -(1 << 62)
# A snapshot is due after this many versions, or once they hold more rows than
# the last snapshot and this many.
VERSIONS = 32
VERSION_ROWS = 1_000_000
# How long a partition may bring nothing and still be waited for.
IDLE_SECONDS = 300.0

STATE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("window", T.LongType()),
        T.StructField("n1", T.LongType()),
        T.StructField("n2", T.LongType()),
        T.StructField("known", T.BooleanType()),
    ]
)
VERSIONED = T.StructType([*STATE.fields, T.StructField("batch", T.IntegerType())])
HEADS = "place string, millis long, seen double"
MARK = "source_batch long, begin long, watermark long, bases map<string, long>, base_rows map<string, long>, version_rows map<string, long>"

# Takes rows, a folder, the number of the step, and the most rows that there can be.
Save = Callable[[DataFrame, str, int, int], None]


@dataclass
class Rules:
    """How the detectors judge."""

    semantics: str = "as_coded"
    window_seconds: int = WINDOW_SECONDS
    threshold_seconds: int = QUICK_SECONDS
    min_clicks: int = MIN_CLICKS
    min_ctr: float = MIN_CTR
    # Seconds after which the windows of `documented` are forgotten; events of
    # forgotten windows are late: kept aside, not judged. None: never.
    delay_seconds: int | None = None
    group_rows: int | None = None

    def check(self, pattern: str) -> None:
        if self.semantics not in READINGS[pattern]:
            raise ValueError(f"semantics must be one of {READINGS[pattern]}, not {self.semantics!r}")

    def judge(self, pattern: str, split: Split) -> DataFrame:
        self.check(pattern)
        if pattern == PATTERN_1:
            return judge_pending(split, self.semantics)
        if pattern == PATTERN_2:
            return judge_quick(split, self.semantics, self.threshold_seconds)
        return judge_hyperactive(split, self.semantics, self.min_clicks, self.min_ctr)

    def flagged(self, pattern: str, judged: DataFrame) -> DataFrame:
        if pattern == PATTERN_1:
            judged = since_suspicious(judged)
        elif pattern == PATTERN_2:
            judged = judged.where("quick")
        else:
            judged = emissions(judged, self.semantics)
        return judged.select(*ORDERED_COLUMNS)

    def numbers(self, pattern: str) -> tuple[Column, Column]:
        """What a window has come to after an event."""
        none = F.lit(0).cast("long")
        if pattern == PATTERN_1:
            return F.col("pending"), none
        if pattern == PATTERN_2:
            return F.col("shown"), none
        return (F.col("seen"), none) if self.semantics == "as_coded" else (F.col("clicks"), F.col("displays"))


@dataclass
class Arrival:
    """How records arrive at a source of several partitions."""

    # Of all topics together.
    partitions: int
    # Seconds without records after which a partition is not waited for. None: it always is.
    idle_seconds: float | None = IDLE_SECONDS
    # The time now, in seconds.
    clock: Callable[[], float] = time.time


@dataclass
class Mark:
    """What a complete step hands on."""

    # The last micro-batch of the source that it covers.
    source_batch: int = -1
    # When the last window opened; 0 before the first one did.
    begin: int = 0
    watermark: int = 0
    # For each pattern: the micro-batch of the last snapshot, its rows, and the rows of versions since.
    bases: dict[str, int] = field(default_factory=dict)
    base_rows: dict[str, int] = field(default_factory=dict)
    version_rows: dict[str, int] = field(default_factory=dict)


class Carried:
    """The tables a stream keeps between micro-batches, below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def mark_path(self, batch_id: int) -> str:
        return f"{self.folder}/marks/batch={batch_id}"

    def staged_path(self, batch_id: int) -> str:
        return f"{self.folder}/staged/batch={batch_id}"

    def state_path(self, pattern: str, batch_id: int) -> str:
        return f"{self.folder}/state/{pattern.replace(' ', '_')}/batch={batch_id}"

    def last(self) -> int:
        """The last complete step, -1 before there is one."""
        steps = [int(name.removeprefix("batch=")) for name in names_in(self.spark, f"{self.folder}/marks")]
        return max((step for step in steps if path_exists(self.spark, f"{self.mark_path(step)}/_SUCCESS")), default=-1)

    def mark(self, batch_id: int) -> Mark:
        if batch_id < 0:
            return Mark()
        row = self.spark.read.schema(MARK).parquet(self.mark_path(batch_id)).first()
        return Mark(**row.asDict())

    def write_mark(self, batch_id: int, mark: Mark) -> None:
        row = (mark.source_batch, mark.begin, mark.watermark, mark.bases, mark.base_rows, mark.version_rows)
        self.spark.createDataFrame([row], MARK).coalesce(1).write.mode("overwrite").parquet(self.mark_path(batch_id))

    def held_path(self, batch_id: int) -> str:
        return f"{self.folder}/held/batch={batch_id}"

    def heads_path(self, batch_id: int) -> str:
        return f"{self.folder}/heads/batch={batch_id}"

    @property
    def flush_path(self) -> str:
        """There while rows that wait are taken in spite of it."""
        return f"{self.folder}/flushing"

    def passed(self, events: DataFrame, step: int, arrival: Arrival, flush: bool) -> DataFrame:
        """The rows, held ones included, that need not wait; others are held."""
        now = arrival.clock()
        place, millis = record_place("seq").alias("place"), record_millis("seq")
        # The source itself is a place without records, seen when it began.
        before = self.spark.createDataFrame([("", None, now)], HEADS)
        heads = events.groupBy(place).agg(F.max(millis).alias("millis"), F.lit(now).alias("seen"))
        if step > 0:
            before = self.spark.read.schema(HEADS).parquet(self.heads_path(step - 1))
            events = events.unionByName(self.spark.read.schema(events.schema).parquet(self.held_path(step - 1)))
        heads = heads.unionByName(before).groupBy("place").agg(
            F.max("millis").alias("millis"), F.when(F.col("place") == "", F.min("seen")).otherwise(F.max("seen")).alias("seen")
        )
        heads.coalesce(1).write.mode("overwrite").parquet(self.heads_path(step))
        # One row for each partition.
        places = {r["place"]: r for r in self.spark.read.schema(HEADS).parquet(self.heads_path(step)).collect()}
        since = now - arrival.idle_seconds if arrival.idle_seconds is not None else float("-inf")
        unseen = arrival.partitions > len(places) - 1 and places.pop("")["seen"] >= since
        waited = [r["millis"] for name, r in places.items() if name and r["seen"] >= since]
        over = F.lit(flush) if flush or unseen else millis < F.lit(min(waited)) if waited else F.lit(True)
        events.where(~over).write.mode("overwrite").parquet(self.held_path(step))
        return events.where(over)

    def state(self, pattern: str, base: int, batch_id: int) -> DataFrame:
        """All versions from the snapshot of micro-batch `base` to before `batch_id`."""
        paths = [self.state_path(pattern, b) for b in range(base, batch_id)]
        if not paths:
            return self.spark.createDataFrame([], VERSIONED)
        root = paths[0].rsplit("/", 1)[0]
        return self.spark.read.schema(VERSIONED).option("basePath", root).parquet(*paths)


def latest(state: DataFrame) -> DataFrame:
    """The last version of every key and window."""
    row = F.max_by(F.struct("n1", "n2", "known"), "batch").alias("row")
    return state.groupBy("key", "window").agg(row).select("key", "window", "row.*")


def carried_rows(state: DataFrame, pattern: str, events: DataFrame, first_seq) -> DataFrame:
    """State as rows in front of the events: displays at an order number before all of them."""
    key = PATTERNS[pattern]
    order = events.schema["seq"].dataType
    columns = {c: F.lit(None).cast(events.schema[c].dataType) for c in ORDERED_COLUMNS}
    columns |= {"seq": F.lit(first_seq).cast(order) - 1, "event_type": F.lit(DISPLAY), key: F.col("key")}
    if pattern == PATTERN_2:
        columns["timestamp"] = F.col("n1")
    return state.select(
        *[column.cast(events.schema[c].dataType).alias(c) for c, column in columns.items()],
        F.lit(False).alias("boundary"), "window", "n1", "n2", "known", F.lit(False).alias("real"),
    )


def judge_batch(
    rules: Rules, pattern: str, events: DataFrame, state: DataFrame, total_rows: int, first_seq
) -> DataFrame:
    """The events (with boundary and window) of a micro-batch and the state they start from, judged."""
    key = PATTERNS[pattern]
    touched = state.join(events.select(F.col(key).alias("key")).distinct(), "key", "left_semi")
    none = F.lit(None).cast("long")
    rows = events.select(
        *ORDERED_COLUMNS, "boundary", "window", none.alias("n1"), none.alias("n2"), F.lit(False).alias("known"), F.lit(True).alias("real")
    ).unionByName(carried_rows(latest(touched), pattern, events, first_seq))
    return rules.judge(pattern, split_hot_keys(rows, [key], total_rows, rules.group_rows, source=events))


def changes(rules: Rules, pattern: str, judged: DataFrame) -> DataFrame:
    """The state rows that a judged micro-batch has changed."""
    key = PATTERNS[pattern]
    n1, n2 = rules.numbers(pattern)
    numbers = (
        judged.groupBy(F.col(key).alias("key"), "window")
        .agg(F.max_by(n1, "seq").cast("long").alias("n1"), F.max_by(n2, "seq").cast("long").alias("n2"), F.bool_or("real").alias("real"))
        .where("real")
        .select("key", "window", "n1", "n2", F.lit(False).alias("known"))
    )
    if pattern == PATTERN_2:
        return numbers
    zero = F.lit(0).cast("long")
    suspicious = (
        judged.groupBy(F.col(key).alias("key"))
        .agg(F.bool_or("hit").alias("hit"), F.bool_or("known").alias("known"))
        .where("hit and not known")
        .select("key", F.lit(KNOWN).cast("long").alias("window"), zero.alias("n1"), zero.alias("n2"), F.lit(True).alias("known"))
    )
    return numbers.unionByName(suspicious)


@dataclass
class Outputs:
    """Where the results of a stream go."""

    # For each pattern the folder of its flagged clicks.
    flagged: dict[str, str]
    save: Save = save_table
    # Called with the rows as they arrived.
    also: Callable[[DataFrame, int], None] | None = None
    # Called with the events, the flagged clicks of each pattern, the number of the step and that of the events.
    totals: Callable[[DataFrame, dict[str, DataFrame], int, int], None] | None = None
    # Where it names a column, only rows for which it holds are events.
    good: str | None = None

    def events(self, rows: DataFrame) -> DataFrame:
        return (rows.where(self.good) if self.good else rows).select(*ORDERED_COLUMNS)


def advance(
    batch: DataFrame, batch_id: int, folder: str, outputs: Outputs, rules: Rules, arrival: Arrival | None = None
) -> None:
    """Take one micro-batch through the detectors.

    With `arrival`, `seq` has to be that of `sources.messages.arrival_order`; rows
    then wait for all outputs but `also`.
    """
    spark = batch.sparkSession
    kept = Carried(spark, f"{folder}/carried")
    if arrival and path_exists(spark, kept.flush_path):
        # A flush that failed goes first; the rows it takes are still there.
        flush(batch, folder, outputs, rules, arrival)
    last = kept.last()
    before = kept.mark(last)
    if not arrival and path_exists(spark, kept.held_path(last)):
        raise RuntimeError(f"rows wait in {folder} for the partitions of the source, which have to be named")
    if before.source_batch < batch_id - 1:
        raise RuntimeError(f"micro-batch {batch_id - 1} has not been completed in {folder}")
    if before.source_batch < batch_id:
        last += 1
        take_step(kept, batch, last, replace(before, source_batch=batch_id), folder, outputs, rules, arrival)
    commit(spark, folder, last)


def flush(like: DataFrame, folder: str, outputs: Outputs, rules: Rules, arrival: Arrival) -> None:
    """Take the rows that still wait through the detectors, as at the end of the input; `like` has the columns of a micro-batch."""
    spark = like.sparkSession
    kept = Carried(spark, f"{folder}/carried")
    last = kept.last()
    if last < 0 or spark.read.parquet(kept.held_path(last)).isEmpty():
        return
    touch(spark, kept.flush_path)
    nothing = spark.createDataFrame([], like.schema)
    take_step(kept, nothing, last + 1, kept.mark(last), folder, outputs, rules, arrival, flushing=True)
    remove_path(spark, kept.flush_path)
    commit(spark, folder, last + 1)


def take_step(
    kept: Carried,
    batch: DataFrame,
    step: int,
    before: Mark,
    folder: str,
    outputs: Outputs,
    rules: Rules,
    arrival: Arrival | None,
    flushing: bool = False,
) -> None:
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(kept.staged_path(step))
    staged = spark.read.schema(batch.schema).parquet(kept.staged_path(step))
    if outputs.also:
        outputs.also(staged, step)
    events = outputs.events(staged)
    if arrival:
        events = kept.passed(events, step, arrival, flushing)
    mark = replace(before, bases=dict(before.bases), base_rows=dict(before.base_rows), version_rows=dict(before.version_rows))
    numbers = events.agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("timestamp").alias("last")).first()
    if numbers["n"]:
        if rules.semantics == "as_coded":
            lookup = boundary_lookup(events, rules.window_seconds, before.begin or None)
            bounded = mark_boundaries(events, lookup).withColumn("window", F.lit(0).cast("long"))
            last = F.max(F.when(F.col("boundary"), F.col("timestamp")))
            first = F.min_by("timestamp", F.when(F.col("timestamp") > 0, F.col("seq")))
            opened = F.coalesce(last, F.lit(before.begin or None).cast("long"), first, F.lit(0))
            mark.begin = bounded.agg(opened.alias("begin")).first()["begin"]
        else:
            bounded = events.withColumns({"boundary": F.lit(False), "window": grid_window(rules.window_seconds)})
            if rules.delay_seconds is not None:
                over = (F.col("window") + 1) * rules.window_seconds <= before.watermark
                labels = F.explode(F.array(*[F.lit(p) for p in outputs.flagged])).alias("pattern")
                save_late(bounded.where(over).select(*ORDERED_COLUMNS, labels), folder, step)
                bounded = bounded.where(~over)
                mark.watermark = max(before.watermark, numbers["last"] - rules.delay_seconds)

    def judge(pattern: str) -> tuple[DataFrame, DataFrame, int, bool]:
        """The judged rows, the flagged ones, and how many state rows were written, as a snapshot or not."""
        state = kept.state(pattern, before.bases.get(pattern, 0), step)
        judged = judge_batch(rules, pattern, bounded, state, numbers["n"], numbers["first_seq"]).persist()
        flagged = rules.flagged(pattern, judged)
        outputs.save(flagged, outputs.flagged[pattern], step, MOST_EMISSIONS * numbers["n"])
        changed = changes(rules, pattern, judged)
        snapshot = snapshot_due(mark, pattern, step)
        if snapshot:
            # The changes are the last version of all.
            whole = latest(state.unionByName(changed.withColumn("batch", F.lit(step))))
            over = (F.col("window") != KNOWN) & ((F.col("window") + 1) * rules.window_seconds <= mark.watermark)
            changed = whole.where(~over) if rules.semantics != "as_coded" else whole
        path = kept.state_path(pattern, step)
        changed.write.mode("overwrite").parquet(path)
        return judged, flagged, spark.read.schema(STATE).parquet(path).count(), snapshot

    if numbers["n"] and outputs.flagged:
        # The patterns share nothing; their jobs run side by side.
        with ThreadPoolExecutor(len(outputs.flagged)) as pool:
            done = dict(zip(outputs.flagged, pool.map(inheritable_thread_target(spark)(judge), outputs.flagged), strict=True))
    else:
        done = {}
        for pattern in outputs.flagged:
            spark.createDataFrame([], STATE).write.mode("overwrite").parquet(kept.state_path(pattern, step))
    for pattern, (*_, n, snapshot) in done.items():
        if snapshot:
            mark.bases[pattern], mark.base_rows[pattern], mark.version_rows[pattern] = step, n, 0
        else:
            mark.version_rows[pattern] = mark.version_rows.get(pattern, 0) + n
    if outputs.totals:
        outputs.totals(events, {pattern: flagged for pattern, (_, flagged, *_) in done.items()}, step, numbers["n"])
    for judged, *_ in done.values():
        judged.unpersist()
    kept.write_mark(step, mark)
    # The mark of this step makes all this superfluous.
    remove_path(spark, kept.staged_path(step))
    remove_path(spark, kept.mark_path(step - 2))
    if arrival:
        for path in (kept.held_path, kept.heads_path):
            remove_path(spark, path(step - 2))
    for pattern in outputs.flagged:
        for b in range(before.bases.get(pattern, 0), mark.bases.get(pattern, 0)):
            remove_path(spark, kept.state_path(pattern, b))


def snapshot_due(mark: Mark, pattern: str, batch_id: int) -> bool:
    versions = batch_id - mark.bases.get(pattern, 0)
    outgrown = mark.version_rows.get(pattern, 0) > mark.base_rows.get(pattern, 0) + VERSION_ROWS
    return versions >= VERSIONS or outgrown


LATE, ROWS = "late", "rows"


def save_late(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """The events, by pattern, that came after their window had been forgotten; `folder` is that of `detect_stream`."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("pattern", T.StringType())])
    path = f"{folder}/late"
    if path_exists(spark, path):
        schema = spark.read.parquet(path).drop("batch").schema
    return read_versions(spark, path, schema, last_commit(spark, folder))


def judge_on_state(rows: DataFrame, folder: str, outputs: Outputs, rules: Rules) -> DataStreamWriter:
    """The documented detectors. The rows themselves go along with what is found in them where an output needs them."""
    spark = rows.sparkSession
    found = judge_stream(outputs.events(rows), rules, tuple(outputs.flagged))
    found = found.withColumn("part", F.when(F.col("late"), LATE).otherwise(F.col("pattern"))).drop("late")
    if outputs.also or outputs.totals:
        found = found.unionByName(rows.withColumn("part", F.lit(ROWS)), allowMissingColumns=True)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= last_commit(spark, folder):
            return
        staged_path = f"{folder}/staged/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("part").parquet(staged_path)
        staged = spark.read.schema(batch.schema).parquet(staged_path)

        def part(name: str, columns: list[str]) -> DataFrame:
            return staged.where(F.col("part") == name).select(*columns)

        sizes = {r["part"]: r["count"] for r in staged.groupBy("part").count().collect()}
        arrived = part(ROWS, rows.columns)
        if outputs.also:
            outputs.also(arrived, batch_id)
        flagged = {pattern: part(pattern, ORDERED_COLUMNS) for pattern in outputs.flagged}
        for pattern, output in outputs.flagged.items():
            outputs.save(flagged[pattern], output, batch_id, sizes.get(pattern, 0))
        if rules.delay_seconds is not None:
            save_late(part(LATE, [*ORDERED_COLUMNS, "pattern"]), folder, batch_id)
        if outputs.totals:
            outputs.totals(outputs.events(arrived), flagged, batch_id, sizes.get(ROWS, 0))
        commit(spark, folder, batch_id)
        remove_path(spark, staged_path)

    return found.writeStream.foreachBatch(one_batch).option("checkpointLocation", f"{folder}/checkpoint")


def detect_stream(
    events: DataFrame, folder: str, outputs: Outputs | dict[str, str], rules: Rules | None = None, arrival: Arrival | None = None
) -> DataStreamWriter:
    """The detectors on a stream of events, or of rows of which `outputs.good` says which are events.

    One query reads the stream, so all outputs cover the same events. With
    `arrival` rows wait for the partitions of the source, see `advance`, and state
    is carried in tables under all rules.
    """
    rules = rules or Rules()
    outputs = outputs if isinstance(outputs, Outputs) else Outputs(outputs)
    for pattern in outputs.flagged:
        rules.check(pattern)
    if rules.semantics != "as_coded" and arrival is None:
        return judge_on_state(events, folder, outputs, rules)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        advance(batch, batch_id, folder, outputs, rules, arrival)

    return events.writeStream.foreachBatch(one_batch).option("checkpointLocation", f"{folder}/checkpoint")
