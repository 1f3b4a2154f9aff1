"""The three detectors of suspicious clicks.

Each takes events (`seq` and the five event columns) and returns the flagged
clicks with the same columns. `semantics` selects the rule:

`as_coded` (default)
    What the running system emits. State is cleared at the boundaries of the
    data-anchored window, but only for the key of the boundary event.
`documented`
    What its comments describe. State belongs to epoch-aligned windows of
    `window_seconds`.
`separate_int`
    Hyperactive addresses only: as documented, with the ratio of clicks to
    displays as an integer division.

The detectors can share `lookup` (see `boundary_lookup`), `hot` (see `hot_keys`)
and `total_rows`, the number of events; `group_rows` is the most rows of one key that stay in one task.

A user or address once found suspicious stays so under all of them. Events
that are not displays count as clicks.
"""

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.columns import grid_window, is_display
from clicksieve.operators.boundaries import boundary_lookup, mark_boundaries
from clicksieve.operators.running import first_time, last_value, running_sums
from clicksieve.operators.skew import Split, split_hot_keys
from clicksieve.schema import MIN_CLICKS, MIN_CTR, ORDERED_COLUMNS, QUICK_SECONDS, WINDOW_SECONDS


def split_and_bound(
    events: DataFrame,
    key: str,
    semantics: str,
    window_seconds: int,
    lookup: DataFrame | None,
    total_rows: int | None,
    group_rows: int | None,
    hot: dict[str, DataFrame | None] | None = None,
    allowed: tuple[str, ...] = ("as_coded", "documented"),
) -> Split:
    """Events split by `key`, with the column that bounds their state: `boundary` or `window`."""
    if semantics not in allowed:
        raise ValueError(f"semantics must be one of {allowed}, not {semantics!r}")
    split = split_hot_keys(events, [key], total_rows, group_rows, hot=hot)
    if semantics != "as_coded":
        return replace(split, df=split.df.withColumn("window", grid_window(window_seconds)))
    if lookup is None:
        lookup = boundary_lookup(events, window_seconds)
    return replace(split, df=mark_boundaries(split.df, lookup))


def carried(df: DataFrame, name: str, step: Column) -> Column:
    """The step of an event, or the number that a row of carried state brings along."""
    return F.coalesce(F.col(name), step) if name in df.columns else step


def known(df: DataFrame) -> Column:
    """Whether a row is carried state that says its key is suspicious already."""
    return F.coalesce("known", F.lit(False)) if "known" in df.columns else F.lit(False)


def judge_pending(split: Split, semantics: str) -> DataFrame:
    """Pattern 1: adds the `pending` displays of the user and `suspicious_from`."""
    steps = {"pending": carried(split.df, "n1", F.when(is_display(), 1).otherwise(-1).cast("long"))}
    if semantics == "as_coded":
        df = running_sums(split, ["uid"], steps, reset=F.col("boundary"))
    else:
        df = running_sums(split, ["uid", "window"], steps, together="uid")
    df = df.withColumn("hit", ~is_display() & (F.col("pending") < 0))
    return first_time(split, df, "uid", F.col("hit") | known(df), "suspicious_from")


def judge_quick(split: Split, semantics: str, threshold_seconds: int) -> DataFrame:
    """Pattern 2: adds when the impression was last `shown`, and whether the event is `quick`."""
    shown_at = F.when(is_display(), F.col("timestamp"))
    if semantics == "as_coded":
        scope, cleared = ["impression_id"], F.col("boundary")
        quick = F.col("shown") - F.col("timestamp") < threshold_seconds
    else:
        scope, cleared = ["impression_id", "window"], F.lit(False)
        delay = F.col("timestamp") - F.col("shown")
        quick = (delay >= 0) & (delay < threshold_seconds)
    return last_value(split, scope, shown_at, cleared, "shown").withColumn("quick", ~is_display() & quick)


def judge_hyperactive(split: Split, semantics: str, min_clicks: int, min_ctr: float) -> DataFrame:
    """Pattern 3: adds the counts of the address, whether they make a `hit`, and `suspicious_from`."""
    if semantics == "as_coded":
        df = running_sums(split, ["ip"], {"seen": carried(split.df, "n1", F.lit(1).cast("long"))}, reset=F.col("boundary"))
        hit = ~is_display() & (F.col("seen") >= min_clicks) & F.lit(min_ctr <= 1)
    else:
        steps = {
            "clicks": carried(split.df, "n1", (~is_display()).cast("long")),
            "displays": carried(split.df, "n2", is_display().cast("long")),
        }
        df = running_sums(split, ["ip", "window"], steps, together="ip")
        if semantics == "documented":
            ratio = F.try_divide(F.col("clicks").cast("double"), F.col("displays").cast("double"))
        else:
            ratio = F.expr("if(displays = 0, null, clicks div displays)")
        hit = ~is_display() & F.coalesce((F.col("clicks") >= min_clicks) & (ratio >= min_ctr), F.lit(False))
    df = df.withColumn("hit", hit)
    return first_time(split, df, "ip", F.col("hit") | known(df), "suspicious_from")


def since_suspicious(df: DataFrame) -> DataFrame:
    return df.where(~is_display() & (F.col("seq") >= F.col("suspicious_from")))


def emissions(judged: DataFrame, semantics: str) -> DataFrame:
    """The flagged clicks of pattern 3, with the number of the emission as `copy`."""
    flagged = since_suspicious(judged)
    if semantics != "as_coded":
        return flagged.withColumn("copy", F.lit(1))
    before = (F.col("seq") > F.col("suspicious_from")).cast("int")
    # A known address below the count gives one row, so there is always at least one.
    return flagged.withColumn("copy", F.explode(F.sequence(F.lit(1), before + F.col("hit").cast("int"))))


def clicks_without_display(
    events: DataFrame,
    semantics: str = "as_coded",
    window_seconds: int = WINDOW_SECONDS,
    lookup: DataFrame | None = None,
    total_rows: int | None = None,
    group_rows: int | None = None,
    hot: dict[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Pattern 1: clicks of a user with no display left to click on, and all later ones."""
    split = split_and_bound(events, "uid", semantics, window_seconds, lookup, total_rows, group_rows, hot)
    return since_suspicious(judge_pending(split, semantics)).select(*ORDERED_COLUMNS)


def quick_clicks(
    events: DataFrame,
    semantics: str = "as_coded",
    window_seconds: int = WINDOW_SECONDS,
    threshold_seconds: int = QUICK_SECONDS,
    lookup: DataFrame | None = None,
    total_rows: int | None = None,
    group_rows: int | None = None,
    hot: dict[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Pattern 2: clicks too close to the last display of their impression.

    `as_coded` subtracts the click from the display, so it takes every click
    unless its display is at least `threshold_seconds` later.
    """
    split = split_and_bound(events, "impression_id", semantics, window_seconds, lookup, total_rows, group_rows, hot)
    return judge_quick(split, semantics, threshold_seconds).where("quick").select(*ORDERED_COLUMNS)


def hyperactive_ips(
    events: DataFrame,
    semantics: str = "as_coded",
    window_seconds: int = WINDOW_SECONDS,
    min_clicks: int = MIN_CLICKS,
    min_ctr: float = MIN_CTR,
    lookup: DataFrame | None = None,
    total_rows: int | None = None,
    group_rows: int | None = None,
    hot: dict[str, DataFrame | None] | None = None,
    keep_copy: bool = False,
) -> DataFrame:
    """Pattern 3: clicks of an address that clicks too much, and all its later ones.

    `as_coded` counts clicks and displays in one counter, which makes the ratio
    always one, and emits a click twice if its address was suspicious before
    and the condition holds again. `keep_copy` adds the number of the emission.
    """
    readings = ("as_coded", "documented", "separate_int")
    split = split_and_bound(events, "ip", semantics, window_seconds, lookup, total_rows, group_rows, hot, readings)
    judged = judge_hyperactive(split, semantics, min_clicks, min_ctr)
    return emissions(judged, semantics).select(*ORDERED_COLUMNS, *(["copy"] if keep_copy else []))


def first_flagged(flagged: DataFrame, key: str) -> DataFrame:
    """Each suspicious user or address and the arrival of its first flagged click."""
    return flagged.groupBy(key).agg(F.min("seq").alias("first_seq"))


def key_segments(
    events: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    lookup: DataFrame | None = None,
    total_rows: int | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """How often the state of an event's user, impression and address had been cleared."""
    if lookup is None:
        lookup = boundary_lookup(events, window_seconds)
    total_rows = events.count() if total_rows is None else total_rows
    df = mark_boundaries(events, lookup).select("seq", "uid", "impression_id", "ip", "boundary")
    for key, name in [("uid", "seg_uid"), ("impression_id", "seg_impression"), ("ip", "seg_ip")]:
        split = split_hot_keys(df, [key], total_rows, group_rows, source=events)
        df = running_sums(split, [key], {name: F.col("boundary").cast("long")}).drop(*split.columns)
    return df.select("seq", "seg_uid", "seg_impression", "seg_ip")
