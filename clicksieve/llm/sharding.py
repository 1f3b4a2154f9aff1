"""Shards of near equal bytes, by sampled splitters.

Rows are put in the order of a key (digest of the text, then id), so that equal
texts lie side by side. Size-weighted samples of keys give splitters that cut
the order into ranges of similar bytes; a range that still holds too much is
sampled again on its own and subdivided. Bytes and rows before each range, and
running sums inside it, then tell every row's place in the whole order, which
is cut into shards at equal bytes. No task sorts more than one range, and a
text that a third of the rows share spreads over as many ranges as it takes.

The cut follows from the order alone: splitters spread the work and never
change the result, except that rows equal in id and text stand in any order
among themselves.

Results in special cases: a null text has no bytes, the checksum of the empty
text and a digest of its own; rows without an id come first among equal texts;
more shards than rows leave some shards empty; an empty table gives an empty
one; other columns are not looked at.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.llm.common import utf8
from clicksieve.session import settle

N_SHARDS = 40
ROW_BYTES = 16
# Ranges per shard, and samples per range.
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 40
# A range is overfull beyond this many times its share of rows or bytes.
OVERFULL = 2.0
# Ranges of fewer rows are sorted as they are.
SMALL_RANGE = 2000
ROUNDS = 4

Key = tuple[str, int]


def keyed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the key (digest, tie) of every row."""
    text = F.col(text_col)
    content = utf8(F.coalesce(text, F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.coalesce(F.md5(utf8(text)), F.lit("")).alias("digest"),
        # Ids that are no numbers are ordered by their hash.
        F.when(F.col(id_col).isNull(), F.lit(-(1 << 63)).cast("long"))
        .otherwise(F.coalesce(F.col(id_col).try_cast("long"), F.xxhash64(id_col)))
        .alias("tie"),
    )


def sampled_keys(rows: DataFrame, n_samples: int, total: int, seed: int) -> list[Key]:
    """About `n_samples` keys, each row as often as its size asks for, sorted.

    `n_samples` bounds what comes to the driver.
    """
    copies = F.floor(F.col("size") * (n_samples / max(total, 1)) + F.rand(seed)).cast("int")
    drawn = rows.select("digest", "tie", copies.alias("copies")).where("copies > 0").orderBy("digest", "tie").collect()
    return [(row["digest"], row["tie"]) for row in drawn for _ in range(row["copies"])]


def quantiles(keys: list[Key], n: int) -> list[Key]:
    """The keys that cut sorted samples into `n` equal parts."""
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def range_number(splitters: list[Key]) -> Column:
    """How many splitters are at or below a row's key: a binary search in a literal array."""
    if not splitters:
        return F.lit(0)
    listed = json.dumps([{"digest": digest, "tie": tie} for digest, tie in splitters])
    cuts = F.from_json(F.lit(listed), "array<struct<digest: string, tie: long>>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(splitters).bit_length()))])
    key = F.struct("digest", "tie")
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(splitters)) & (F.get(cuts, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def _range_sizes(rows: DataFrame, splitters: list[Key]) -> list[tuple[int, int, int]]:
    """(range, rows, bytes), for as many ranges as there are splitters."""
    found = rows.groupBy(range_number(splitters).alias("range")).agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    return sorted((r["range"], r["n"], r["b"]) for r in found.collect())


def find_splitters(rows: DataFrame, n_ranges: int, seed: int = 7) -> tuple[list[Key], list[tuple[int, int, int]]]:
    """Splitters, and rows and bytes of the ranges they make."""
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    splitters = quantiles(sampled_keys(rows, n_ranges * SAMPLES_PER_RANGE, total, seed), n_ranges)
    sizes = _range_sizes(rows, splitters)
    for again in range(ROUNDS):
        parts = {
            r: math.ceil(max(n / count, b / total) * n_ranges)
            for r, n, b in sizes
            if n > SMALL_RANGE and max(n / count, b / total) * n_ranges > OVERFULL
        }
        if not parts:
            break
        ranged = rows.withColumn("range", range_number(splitters))
        more = set(splitters)
        overfull = ranged.where(F.col("range").isin(list(parts)))
        # Rows weigh alike here: a range may be overfull by count.
        inside = overfull.withColumn("size", F.col("size") * F.lit(1.0) / total + F.lit(1.0) / count)
        samples = sampled_keys(inside, sum(parts.values()) * SAMPLES_PER_RANGE, inside.agg(F.sum("size")).first()[0], seed + 1 + again)
        edges = [("", -(1 << 63)), *splitters]
        for r, n_parts in parts.items():
            high = splitters[r] if r < len(splitters) else None
            more |= set(quantiles([k for k in samples if k >= edges[r] and (high is None or k < high)], n_parts))
        if len(more) == len(splitters):
            break  # what is left are rows of one key
        splitters = sorted(more)
        sizes = _range_sizes(rows, splitters)
    return splitters, sizes


def shard_by_bytes(
    docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (its place in the shard, from 0)."""
    spark = docs.sparkSession
    rows = settle(keyed_sizes(docs, id_col, text_col))
    splitters, sizes = find_splitters(rows, n_shards * RANGES_PER_SHARD)
    total = sum(b for _, _, b in sizes)
    before, n_before, b_before = [], 0, 0
    for r, n, b in sizes:
        before.append((r, n_before, b_before))
        n_before, b_before = n_before + n, b_before + b
    starts = spark.createDataFrame(before, "range int, n_before long, b_before long")
    in_order = Window.partitionBy("range").orderBy("digest", "tie")
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = rows.withColumn("range", range_number(splitters)).join(F.broadcast(starts), "range")  # a row per range
    placed = ranged.select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("n_before") + F.row_number().over(in_order) - 1).alias("place"),
        (F.col("b_before") + F.sum("size").over(running)).alias("b_with"),
    )
    # The middle byte of a row tells its shard.
    shard = F.expr(f"cast((b_with - size div 2 - 1) * {n_shards} div {max(total, 1)} as int)")
    placed = settle(placed.select("doc_id", "size", "text_crc32", "place", shard.alias("shard")))
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(firsts), "shard").select(  # a row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
