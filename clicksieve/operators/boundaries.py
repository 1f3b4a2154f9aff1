"""Boundaries of the data-anchored window.

The first event opens a window. An event at least `window_seconds` later than
the event that opened the current window is a boundary and opens the next one.
"Next" means next in arrival order (`seq`), and the window is shared by all keys.

Only the first event of each second can matter, so one aggregate reduces the
events to one row per second. Among these only those matter that no later second
precedes in arrival order; there both `seq` and `timestamp` increase, and the next
boundary is simply the first row at or after `begin + window_seconds`. That chain
is followed in parallel over long stretches of time: each stretch first works out
where a chain that enters it would leave it, for the few rows at which one can
enter; passes over these pick the true entries, block of stretches by block where
there are many; then each stretch lists its boundaries. No task ever sees more
than one stretch of seconds or the entries of one block.
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.schema import WINDOW_SECONDS
from clicksieve.session import settle, small_side

# Python workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Length of a stretch, and so the most rows a task holds at once. Some windows
# have to fit, as a chain can enter at any second of the first one.
STRETCH_SECONDS = 1 << 18
STRETCH_WINDOWS = 32
# Stretches whose entries one task follows at most.
BLOCK_STRETCHES = 64


def first_per_second(events: DataFrame, stretch_seconds: int) -> DataFrame:
    return (
        events.where(F.col("timestamp") > 0)
        .groupBy("timestamp")
        .agg(F.min("seq").alias("seq"))
        .withColumn("stretch", F.floor(F.col("timestamp") / F.lit(stretch_seconds)).cast("long"))
    )


def leading_in_stretch(seconds: DataFrame) -> DataFrame:
    """The rows that arrive before every row of a later second of their stretch."""
    after = Window.partitionBy("stretch").orderBy(F.desc("timestamp")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        seconds.withColumn("later", F.min("seq").over(after))
        .where(F.col("later").isNull() | (F.col("seq") < F.col("later")))
        .drop("later")
    )


def leading_overall(leading: DataFrame) -> DataFrame:
    """Of these, the rows that also arrive before every row of a later stretch."""
    # One row per stretch, some hundred for each year covered.
    after = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    first = leading.groupBy("stretch").agg(F.min("seq").alias("seq"))
    later = first.select("stretch", F.min("seq").over(after).alias("later"))
    return (
        leading.join(later, "stretch")
        .where(F.col("later").isNull() | (F.col("seq") < F.col("later")))
        .select("stretch", "timestamp", "seq")
    )


def window_boundaries(
    events: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    begin: int | None = None,
    stretch_seconds: int | None = None,
    block_stretches: int = BLOCK_STRETCHES,
) -> DataFrame:
    """The boundary events as (seq, timestamp).

    `begin` is the opening timestamp of a window already under way. Without it
    the first event opens the first window and is no boundary itself.
    """
    if stretch_seconds is None:
        stretch_seconds = max(STRETCH_SECONDS, STRETCH_WINDOWS * window_seconds)
    order = events.schema["seq"].dataType
    if begin is not None:
        events = events.where(F.col("timestamp") >= begin + window_seconds)
    leading = leading_overall(settle(leading_in_stretch(first_per_second(events, stretch_seconds))))

    def exits(width: int):
        """For the rows at which a chain can enter a stretch, or `width` of them: where it resumes after its end."""

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("entry", ignore_index=True)
            entry, resume = rows["entry"].to_numpy(), rows["resume"].to_numpy()
            n = len(entry)
            following = np.searchsorted(entry, resume)
            last = np.where(following < n, following, np.arange(n))
            while True:
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            start = int(rows["stretch"].iloc[0]) // width * width * stretch_seconds
            enterable = np.append(True, entry[:-1] < start + window_seconds)
            return pd.DataFrame({"stretch": rows["stretch"].iloc[0] // width, "entry": entry[enterable], "resume": resume[last[enterable]]})

        return run

    def entries(rows: pd.DataFrame) -> pd.DataFrame:
        """Where the chain enters stretches, from where it enters the first one or enters their block."""
        rows = rows.sort_values("entry", ignore_index=True)
        entry, resume = rows["entry"].to_numpy(), rows["resume"].to_numpy()
        taken = []
        i = int(np.searchsorted(entry, rows["enters"].iloc[0]))
        while i < len(entry):
            taken.append(i)
            i = int(np.searchsorted(entry, resume[i]))
        opens = bool(rows["opens"].iloc[0])
        return rows.loc[taken, ["stretch", "entry"]].assign(opens=[opens and i == taken[0] for i in taken])

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("timestamp", ignore_index=True)
        ts = rows["timestamp"].to_numpy()
        taken = []
        i = int(np.searchsorted(ts, rows["entry"].iloc[0]))
        while i < len(ts):
            taken.append(i)
            i = int(np.searchsorted(ts, ts[i] + window_seconds))
        if begin is None and rows["opens"].iloc[0]:
            taken = taken[1:]
        return rows.loc[taken, ["seq", "timestamp"]]

    result = T.StructType([T.StructField("seq", order), T.StructField("timestamp", T.LongType())])
    # At most window_seconds + 1 rows of a stretch, or of a block of them, go on.
    passing, chosen = "stretch long, entry long, resume long", "stretch long, entry long, opens boolean"
    own = leading.select("stretch", F.col("timestamp").alias("entry"), (F.col("timestamp") + window_seconds).alias("resume"))
    maps = [own.groupBy("stretch").applyInPandas(exits(1), passing)]
    span = leading.agg(F.min("stretch").alias("low"), F.max("stretch").alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    block = F.floor(F.col("stretch") / F.lit(block_stretches)).cast("long").alias("block")
    while high - low >= block_stretches:
        # Too many for one group: blocks of stretches are passed as single stretches are.
        maps[-1] = settle(maps[-1])
        width = block_stretches ** len(maps)
        lower = maps[-1].select(block, (F.col("stretch") * (width // block_stretches)).alias("stretch"), "entry", "resume")
        maps.append(lower.groupBy("block").applyInPandas(exits(width), passing))
        low, high = low // block_stretches, high // block_stretches
    top = maps.pop().select("*", F.lit(-(1 << 62)).alias("enters"), F.lit(True).alias("opens"))
    entered = top.groupBy().applyInPandas(entries, chosen)
    while maps:
        enters = entered.select(F.col("stretch").alias("block"), F.col("entry").alias("enters"), "opens")
        entered = maps.pop().withColumn("block", block).join(enters, "block").groupBy("block").applyInPandas(entries, chosen)
    return leading.join(entered, "stretch").groupBy("stretch").applyInPandas(walk, result)


def boundary_lookup(events: DataFrame, window_seconds: int = WINDOW_SECONDS, begin: int | None = None) -> DataFrame:
    """The boundaries, computed once, as a join side (seq, boundary).

    There is at most one boundary per `window_seconds` of time covered, so they
    are looked up by broadcast; should there be too many, the lookup is a
    shuffle join.
    """
    boundaries = settle(window_boundaries(events, window_seconds, begin))
    return small_side(boundaries.select("seq", F.lit(True).alias("boundary")))


def mark_boundaries(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """`events` with a boolean `boundary`."""
    return events.join(lookup, "seq", "left").withColumn("boundary", F.coalesce("boundary", F.lit(False)))
