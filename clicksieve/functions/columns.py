"""Column expressions over event rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicksieve.schema import CLICK, DISPLAY, WINDOW_SECONDS


def is_display(event_type: str = "event_type") -> Column:
    return F.col(event_type) == DISPLAY


def role(event_type: str = "event_type") -> Column:
    """What a detector takes an event for: everything but a display is a click."""
    return F.when(is_display(event_type), DISPLAY).otherwise(CLICK)


def event_time(timestamp: str = "timestamp") -> Column:
    return F.timestamp_seconds(F.col(timestamp))


def utc_time(seconds: Column) -> Column:
    """Seconds since the epoch as a UTC time without a zone, whatever the zone of the session."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def hour_bucket(timestamp: str = "timestamp") -> Column:
    """Name of the hourly output folder of an event in UTC, such as 2021-07-08--16."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col(timestamp) / 86400).cast("int"))
    hour = F.floor(F.pmod(F.col(timestamp), F.lit(86400)) / 3600)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.format_string("--%02d", hour))


# Seconds that event times may have: the years 1 to 9999.
MIN_SECONDS, MAX_SECONDS = -62_135_596_800, 253_402_300_799


def has_time(timestamp: str = "timestamp") -> Column:
    """Whether the seconds of an event name a time at all."""
    return F.col(timestamp).between(MIN_SECONDS, MAX_SECONDS)


def grid_window(window_seconds: int = WINDOW_SECONDS, timestamp: str = "timestamp") -> Column:
    """Number of the epoch-aligned window an event falls into."""
    return F.floor(F.col(timestamp) / F.lit(window_seconds)).cast("long")


def on_one_line(text: str) -> Column:
    """A text with line breaks, and the sign that marks them, written as two characters."""
    out = F.replace(F.col(text), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def event_line() -> Column:
    """The event as one line of the text log; a missing value is written as null."""
    # Fixed value: the format of a log line.
    line = "Event{eventType='%s', uid='%s', timestamp=%s, ip='%s', impressionId='%s'}"
    timestamp = F.col("timestamp").cast("string")
    return F.format_string(line, *map(on_one_line, ("event_type", "uid")), timestamp, *map(on_one_line, ("ip", "impression_id")))


def event_json() -> Column:
    """The event as a JSON message."""
    return F.to_json(
        F.struct(
            F.col("event_type").alias("eventType"),
            "uid",
            "timestamp",
            "ip",
            F.col("impression_id").alias("impressionId"),
        )
    )


def percent(ratio: Column) -> Column:
    """A ratio in percent, its exact binary value rounded to the nearest tenth, ties to even."""
    return F.concat(F.coalesce(F.call_function("format_number", 100 * ratio, F.lit("0.0")), F.lit("null")), F.lit("%"))
