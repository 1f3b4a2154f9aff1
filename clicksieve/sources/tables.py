"""Click events out of the general `events` table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.schema import CLICK, DISPLAY

RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def map_events(raw: DataFrame, keep_other_types: bool = False) -> DataFrame:
    """Views become displays, clicks stay; the arrival order is the event id."""
    if not keep_other_types:
        raw = raw.where(F.col("event_type").isin("view", "click"))
    return raw.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "view", DISPLAY)
        .when(F.col("event_type") == "click", CLICK)
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("user_id").cast("string").alias("uid"),
        # Times of the table have no zone; they are taken as UTC whatever the session's zone.
        F.expr(
            "datediff(cast(ts as date), date'1970-01-01') * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
        ).alias("timestamp"),
        F.concat(F.lit("10.0.0."), F.get_json_object("props", "$.k")).alias("ip"),
        F.concat(F.col("user_id"), F.expr("'-' || replace(cast(cast(ts as date) as string), '-', '')")).alias(
            "impression_id"
        ),
    )


def click_events(spark: SparkSession, sf_dir: str, keep_other_types: bool = False) -> DataFrame:
    raw = spark.read.schema(RAW_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return map_events(raw, keep_other_types)
