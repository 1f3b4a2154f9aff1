"""Which micro-batches of a stream are complete in all their outputs.

A micro-batch writes several tables one after the other. Once all are there it
leaves an empty file with its number; readers take what was written up to the
last of these, and so never see half a micro-batch, whether it is under way or
has failed.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.session import names_in, path_exists, remove_path, touch

# Commit files that are kept; readers need the last one only.
KEPT = 2


def _path(folder: str, batch_id: int) -> str:
    return f"{folder}/commits/{batch_id:012d}"


def commit(spark: SparkSession, folder: str, batch_id: int) -> None:
    touch(spark, _path(folder, batch_id))
    for old in committed(spark, folder)[:-KEPT]:
        remove_path(spark, _path(folder, old))


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the commit files there are, ascending."""
    return sorted(int(name) for name in names_in(spark, f"{folder}/commits") if name.isdigit())


def last_commit(spark: SparkSession, folder: str) -> int:
    """The last complete micro-batch, -1 before there is one."""
    return max(committed(spark, folder), default=-1)


def read_versions(spark: SparkSession, path: str, schema: T.StructType, last: int) -> DataFrame:
    """What micro-batches up to `last` wrote below `batch=...` of a folder, which may not be there yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    versioned = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(versioned).parquet(path).where(F.col("batch") <= last).drop("batch")
