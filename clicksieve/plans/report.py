"""The detection run and its click-through report."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from clicksieve.functions.columns import percent
from clicksieve.operators.boundaries import boundary_lookup
from clicksieve.operators.counts import label_patterns
from clicksieve.operators.detectors import clicks_without_display, hyperactive_ips, quick_clicks
from clicksieve.operators.skew import hot_keys
from clicksieve.schema import CLICK, DISPLAY, EVENT_COLUMNS, PATTERN_1, PATTERN_2, PATTERN_3, WINDOW_SECONDS


@dataclass
class Detection:
    events: DataFrame
    p1: DataFrame
    p2: DataFrame
    p3: DataFrame
    # Displays and clicks of `events`, where they have been counted already.
    counted: Row | None = None

    def labelled(self) -> DataFrame:
        return label_patterns(self.p1, self.p2, self.p3)

    def union_all(self) -> DataFrame:
        """Flagged clicks of all detectors, overlaps included."""
        parts = [p.select(*EVENT_COLUMNS) for p in (self.p1, self.p2, self.p3)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def distinct(self) -> DataFrame:
        """Flagged clicks without repeats; events equal in all five columns are one."""
        return self.union_all().distinct()


def detect(
    events: DataFrame,
    semantics: str = "as_coded",
    window_seconds: int = WINDOW_SECONDS,
    group_rows: int | None = None,
) -> Detection:
    """Run the three detectors; they share one pass for counts, one for hot keys, and the window boundaries."""
    counted = type_counts(events).first()
    shared = {
        "semantics": semantics,
        "window_seconds": window_seconds,
        "total_rows": counted["n"],
        "group_rows": group_rows,
        "hot": hot_keys(events, ["uid", "impression_id", "ip"], counted["n"], group_rows),
    }
    if semantics == "as_coded":
        shared["lookup"] = boundary_lookup(events, window_seconds)
    return Detection(
        events,
        clicks_without_display(events, **shared),
        quick_clicks(events, **shared),
        hyperactive_ips(events, keep_copy=True, **shared),
        counted,
    )


def type_counts(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count_if(F.col("event_type") == DISPLAY).alias("n_displays"),
        F.count_if(F.col("event_type") == CLICK).alias("n_clicks"),
        F.count("*").alias("n"),
    )


def ratio(clicks: Column) -> Column:
    return F.try_divide(clicks.cast("double"), F.col("n_displays").cast("double"))


def ctr(events: DataFrame) -> DataFrame:
    """Clicks per display; null without displays."""
    return type_counts(events).drop("n").withColumn("ctr", ratio(F.col("n_clicks")))


def flagged_counts(detection: Detection) -> DataFrame:
    """One row: clicks flagged by each detector, repeats included, and distinct ones in all."""
    by_pattern = [
        F.count_if(F.col("pattern") == label).alias(name)
        for label, name in [(PATTERN_1, "n_1"), (PATTERN_2, "n_2"), (PATTERN_3, "n_3")]
    ]
    return (
        detection.labelled()
        .groupBy(*EVENT_COLUMNS)
        .agg(*by_pattern)
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("n_1", "n_2", "n_3")], F.count("*").alias("n_invalid"))
    )


def ctr_after_fraud(detection: Detection) -> DataFrame:
    """Clicks per display once the flagged clicks are taken off, with the counts it is made of."""
    flagged, counted = flagged_counts(detection), detection.counted
    if counted is None:
        counted = type_counts(detection.events).first()
    return flagged.select(
        F.lit(counted["n_displays"]).alias("n_displays"), F.lit(counted["n_clicks"]).alias("n_clicks"), "*"
    ).withColumn("ctr", ratio(F.col("n_clicks") - F.col("n_invalid")))


def report_numbers(detection: Detection) -> DataFrame:
    """The numbers of the report in one row."""
    numbers = ctr_after_fraud(detection)
    return numbers.withColumnRenamed("ctr", "ctr_after").withColumn("ctr_before", ratio(F.col("n_clicks")))


def report_lines(detection: Detection) -> DataFrame:
    """The report as numbered sentences."""
    numbers = report_numbers(detection)
    # The sentences of the report.
    sentences = [
        F.format_string("The click-through-rate equals %s.", percent(F.col("ctr_before"))),
        F.format_string(
            "%d clicks have been detected as fraudulent out of %d clicks.", F.col("n_invalid"), F.col("n_clicks")
        ),
        F.format_string("The click-through-rate equals %s.", percent(F.col("ctr_after"))),
        F.format_string(
            "The pattern that detects clicks without corresponding displays flagged %d clicks.", F.col("n_1")
        ),
        F.format_string("The pattern that detects clicks that occured too fast flagged %d clicks.", F.col("n_2")),
        F.format_string("The pattern that detects clicks with hyperactive IP addresses %d clicks.", F.col("n_3")),
    ]
    return numbers.select(F.posexplode(F.array(*sentences)).alias("at", "text")).select(
        (F.col("at") + 1).alias("line_no"), "text"
    )
