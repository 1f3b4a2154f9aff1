"""Session settings, and the shared folder that intermediate tables go to."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes a broadcast side may have.
BROADCAST_BYTES = 64 << 20


def build_session(
    app_name: str = "clicksieve", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the package relies on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors can reach.

    Where the setting is absent a temporary folder is made, but only if driver
    and executors are one process; a cluster has to name its folder. Its file
    system may be local if all executors are on the driver's machine.
    """
    context = spark.sparkContext
    one_process = context.master.startswith("local") and not context.master.startswith("local-cluster")
    one_machine = re.match(r"local\b|spark://(localhost|127\.[\d.]+)(:|$)", context.master)
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not one_process:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="clicksieve-")
    if not one_process and "://" not in folder and not re.match(r"\w+:/", folder):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        if default.startswith("file:") and not one_machine:
            raise RuntimeError(f"spark.checkpoint.dir is {folder}, which is local to each machine; name its file system")
        # Processes work in folders of their own, so the path has to be whole.
        named, files = _file_system(spark, folder)
        folder = files.makeQualified(named).toString()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_run_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named, named.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    named, files = _file_system(spark, path)
    return files.exists(named)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it, if it is there."""
    named, files = _file_system(spark, path)
    files.delete(named, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what is in a folder; none where there is no folder."""
    named, files = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(named)] if files.exists(named) else []


def last_change(spark: SparkSession, path: str) -> float:
    """When something was last put into a folder, in seconds since the epoch."""
    named, files = _file_system(spark, path)
    times = [status.getModificationTime() for status in files.listStatus(named)] + [files.getFileStatus(named).getModificationTime()]
    return max(times) / 1000


def bytes_below(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a folder."""
    named, files = _file_system(spark, path)
    return files.getContentSummary(named).getLength()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, whether it is there already or not."""
    named, files = _file_system(spark, path)
    files.create(named, True).close()


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once into the shared folder and read it from there afterwards."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def measured_bytes(df: DataFrame) -> int:
    """The bytes of all rows: those of texts, and 16 for every other value."""
    wide = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if f.dataType.typeName() in ("string", "binary") else F.lit(16)
        for f in df.schema
    ]
    return df.agg(F.coalesce(F.sum(sum(wide[1:], wide[0])), F.lit(0))).first()[0]


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a settled join side for broadcast if it has at most `limit` bytes.

    A larger one is returned as it is and joins by shuffle.
    """
    if measured_bytes(df) <= limit:
        return F.broadcast(df)
    return df
