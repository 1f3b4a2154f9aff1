"""The event schema and the fixed values every module shares."""

from pyspark.sql import types as T

# Field names of the JSON messages and of the text log.
JSON_FIELDS = {
    "eventType": "event_type",
    "uid": "uid",
    "timestamp": "timestamp",
    "ip": "ip",
    "impressionId": "impression_id",
}

# The two event types and the labels of the three detectors.
DISPLAY = "display"
CLICK = "click"
PATTERN_1 = "Pattern 1"
PATTERN_2 = "Pattern 2"
PATTERN_3 = "Pattern 3"

# Detector settings.
WINDOW_SECONDS = 30 * 60
QUICK_SECONDS = 2
MIN_CLICKS = 10
MIN_CTR = 0.3

EVENT_COLUMNS = ["event_type", "uid", "timestamp", "ip", "impression_id"]
ORDERED_COLUMNS = ["seq", *EVENT_COLUMNS]

JSON_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "timestamp" else T.StringType())
        for name in JSON_FIELDS
    ]
)

EVENT_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType())]
    + [
        T.StructField(name, T.LongType() if name == "timestamp" else T.StringType())
        for name in EVENT_COLUMNS
    ]
)
