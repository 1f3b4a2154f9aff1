"""The text log: one event per line, in hourly folders."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.functions.columns import has_time
from clicksieve.schema import EVENT_COLUMNS
from clicksieve.session import path_exists
from clicksieve.sources.messages import Decoded

# Fixed value: the format of a log line.
LINE_PATTERN = r"(?s)^Event\{eventType='(.*)', uid='(.*)', timestamp=(-?\d+|null), ip='(.*)', impressionId='(.*)'\}$"

# Folder of each of the four outputs.
OUTPUTS = {
    "all": "all",
    "Pattern 1": "snapshots_pattern_1",
    "Pattern 2": "snapshots_pattern_2",
    "Pattern 3": "snapshots_pattern_3",
}


def back(field: Column) -> Column:
    """A field as it was before `on_one_line`."""
    # Escaped signs are put aside while the line breaks come back; no line holds a line break itself.
    aside = F.replace(field, F.lit("\\\\"), F.lit("\n"))
    aside = F.replace(aside, F.lit("\\r"), F.lit("\r"))
    parts = F.transform(F.split(aside, "\n"), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return F.when(F.contains(field, F.lit("\\")), F.array_join(parts, "\\")).otherwise(field)


def parse_lines(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> Decoded:
    """Events of log lines, and the lines that are none.

    Rejected are lines of another form, and seconds that are no time between the
    years 1 and 9999. The pattern runs once per line: it leaves the five fields
    separated by line breaks, which no line contains.
    """
    fields = F.split(F.regexp_replace(line, LINE_PATTERN, "$1\n$2\n$3\n$4\n$5"), "\n")
    single = F.when(~F.contains(F.col(line), F.lit("\n")), fields)
    split = lines.select(*keep, F.col(line).alias("_text"), F.explode(F.array(single)).alias("field"))
    is_line = F.coalesce(F.size("field") == 5, F.lit(False))
    number = F.get("field", 2)
    parsed = split.select(
        *keep,
        *[back(F.get("field", i)).alias(name) for i, name in ((0, "event_type"), (1, "uid"))],
        number.try_cast("long").alias("timestamp"),
        *[back(F.get("field", i)).alias(name) for i, name in ((3, "ip"), (4, "impression_id"))],
        F.col("_text").alias("value"),
        is_line.alias("is_line"),
        F.coalesce(number == "null", F.lit(False)).alias("no_time"),
    )
    good = F.col("is_line") & (F.col("no_time") | F.coalesce(has_time(), F.lit(False)))
    return Decoded(parsed.select(*keep, *EVENT_COLUMNS, "value", good.alias("good")), keep)


def read_log(spark: SparkSession, path: str) -> Decoded:
    return parse_lines(spark.read.text(path))


def bucket_lines(spark: SparkSession, path: str, bucket: str | None = None) -> DataFrame:
    """The lines below hourly folders with the folders they stand in; other hours than `bucket` are not read."""
    only = f"{path}/bucket={bucket}"
    if path_exists(spark, path if bucket is None else only):
        # Other hours are not even listed.
        lines = spark.read.option("basePath", path).text(path if bucket is None else only)
        # Folders without a file have no such columns.
        if "batch" in lines.columns:
            return lines
    return spark.createDataFrame([], "value string, bucket string, batch int")


def read_bucket(spark: SparkSession, root: str, output: str, bucket: str) -> Decoded:
    """The events of one output in one hour, e.g. bucket 2021-07-08--16; other hours are not read."""
    return parse_lines(bucket_lines(spark, f"{root}/{OUTPUTS[output]}", bucket))
