"""The hourly logs of a running job: consistent reads, and files of a good size.

Micro-batches leave a small file each in an hour. `compact` writes the lines of
closed hours anew into as many files as their bytes need, in a folder that counts
once Spark has marked it complete; from then on readers take its hours in place
of the micro-batches it covers. These are removed by the next call only, so
readers that have started still find them, and whatever breaks in between loses
nothing.
"""

import time
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clicksieve.session import bytes_below, last_change, names_in, path_exists, remove_path
from clicksieve.sources.messages import Decoded
from clicksieve.sources.textlog import OUTPUTS, bucket_lines, parse_lines

# Fixed value: bytes at which an output file is closed.
FILE_BYTES = 1 << 30
# Fixed value: seconds without a line after which it is closed.
IDLE_SECONDS = 300.0


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    return sorted(int(n.removeprefix(f"{name}=")) for n in names_in(spark, folder) if n.startswith(f"{name}="))


def _hours(spark: SparkSession, folder: str) -> list[str]:
    return [n.removeprefix("bucket=") for n in names_in(spark, folder) if n.startswith("bucket=")]


def _compacted(root: str, output: str) -> str:
    return f"{root}/compacted/{OUTPUTS[output]}"


def _runs(spark: SparkSession, folder: str) -> list[tuple[int, int]]:
    """The folders of compactions as (micro-batch they cover up to, number among those), ascending."""
    names = [n.removeprefix("upto=").split("-") for n in names_in(spark, folder) if n.startswith("upto=")]
    return sorted((int(upto), int(number)) for upto, number in names)


def _run(folder: str, run: tuple[int, int]) -> str:
    return f"{folder}/upto={run[0]}-{run[1]}"


def covered(spark: SparkSession, root: str, output: str, last: int, bucket: str | None = None) -> dict[str, tuple[int, int]]:
    """For each compacted hour the newest complete compaction that has it."""
    folder, found = _compacted(root, output), {}
    for run in _runs(spark, folder):
        at = _run(folder, run)
        if run[0] <= last and path_exists(spark, f"{at}/_SUCCESS"):
            hours = _hours(spark, at) if bucket is None else [bucket] * path_exists(spark, f"{at}/bucket={bucket}")
            found |= dict.fromkeys(hours, run)
    return found


def read_output(spark: SparkSession, root: str, output: str, last: int, bucket: str | None = None) -> Decoded:
    """The events of an output, or of one hour of it, as of micro-batch `last`."""
    lines = bucket_lines(spark, f"{root}/{OUTPUTS[output]}", bucket).where(F.col("batch") <= last)
    done = covered(spark, root, output, last, bucket)
    if not done:
        return parse_lines(lines)
    # One row for each compacted hour.
    replaced = F.broadcast(spark.createDataFrame([(hour, run[0]) for hour, run in done.items()], "bucket string, upto long"))
    newer = lines.join(replaced, "bucket", "left").where(F.coalesce(F.col("batch") > F.col("upto"), F.lit(True)))
    folders = [f"{_run(_compacted(root, output), run)}/bucket={hour}" for hour, run in done.items()]
    return parse_lines(newer.select("value").union(spark.read.schema("value string").text(folders)))


def compact(
    spark: SparkSession,
    root: str,
    before: str | None,
    last: int,
    file_bytes: int = FILE_BYTES,
    idle_seconds: float = IDLE_SECONDS,
    clock: Callable[[], float] = time.time,
) -> dict[tuple[str, str], int]:
    """Bring the lines of closed hours into files of about `file_bytes` at most.

    Closed are the hours before bucket `before`; without it, those that nothing has
    been written to for `idle_seconds`. Covers micro-batches up to `last`. Returns
    the number of files for each (output, hour) written anew.
    """
    written, idle_since = {}, clock() - idle_seconds

    def closed(place: str, hour: str) -> bool:
        return hour < before if before is not None else last_change(spark, f"{place}/bucket={hour}") <= idle_since

    for output, name in OUTPUTS.items():
        place, target = f"{root}/{name}", _compacted(root, output)
        done = covered(spark, root, output, last)
        remove_superseded(spark, place, target, done)
        # One entry for each closed hour with anything new.
        files, sources = {}, []
        for hour in _hours(spark, place):
            new = [f"{place}/bucket={hour}/batch={n}" for n in _numbers(spark, f"{place}/bucket={hour}", "batch") if n <= last]
            if new and closed(place, hour):
                if hour in done:
                    new.append(f"{_run(target, done[hour])}/bucket={hour}")
                files[hour] = -(-sum(bytes_below(spark, path) for path in new) // file_bytes) or 1
                sources += new
        if files:
            # A folder without the mark of completeness is what is left of a call that failed.
            runs = [run for run in _runs(spark, target) if run[0] == last and path_exists(spark, f"{_run(target, run)}/_SUCCESS")]
            write_compacted(spark, sources, files, _run(target, (last, len(runs))))
            written |= {(output, hour): n for hour, n in files.items()}
    return written


def write_compacted(spark: SparkSession, sources: list[str], files: dict[str, int], folder: str) -> None:
    """The lines of the source folders into as many files for each hour as `files` says, one task for each file."""
    lines = spark.read.schema("value string").text(sources)
    hour = F.regexp_extract("_metadata.file_path", r"/bucket=([^/]+)/", 1)
    first = dict(zip(files, accumulate(files.values(), initial=0), strict=False))
    # One row for each hour.
    wanted = F.broadcast(spark.createDataFrame([(h, first[h], n) for h, n in files.items()], "bucket string, first long, files long"))
    task = F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("files"))
    dealt = lines.select("value", hour.alias("bucket")).join(wanted, "bucket").select("value", "bucket", task.cast("int").alias("task"))
    named = dealt.repartitionById(sum(files.values()), "task").drop("task")
    named.write.partitionBy("bucket").mode("overwrite").text(folder)


def remove_superseded(spark: SparkSession, place: str, target: str, done: dict[str, tuple[int, int]]) -> None:
    """What an earlier call has replaced; readers that started before that have ended by now."""
    for hour, (upto, _) in done.items():
        for n in _numbers(spark, f"{place}/bucket={hour}", "batch"):
            if n <= upto:
                remove_path(spark, f"{place}/bucket={hour}/batch={n}")
    for run in _runs(spark, target):
        for hour in _hours(spark, _run(target, run)):
            if hour in done and run < done[hour]:
                remove_path(spark, f"{_run(target, run)}/bucket={hour}")
