"""Splitting keys that hold too many rows for one task.

A running value over a key needs the key's rows in order. For a key with very
many rows the rows are cut into consecutive ranges of `seq`, the same cut points
for all keys, and each (key, range) becomes a group of its own. What a range
needs to know of earlier ranges is aggregated separately and joined on. Keys
below the limit stay in one group and skip all of this.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.session import settle, small_side

# A key with no more rows than this stays whole.
GROUP_ROWS = 500_000
# At most this many keys are above the limit, and at most this many ranges are
# cut, whatever the data size: beyond 5 * 10^10 rows the limit grows.
HOT_KEYS = 100_000
# Rows sampled of a key at the limit, and of a range to be cut off.
SAMPLED_KEY_ROWS = 2000
SAMPLED_RANGE_ROWS = 100

# Range number of the rows of keys that stay whole.
WHOLE = -1


@dataclass
class Split:
    """A frame ready for running values over `keys`.

    `columns` is what to add to the partitioning: nothing while no key is split.
    """

    df: DataFrame
    columns: list[str] = field(default_factory=list)

    @property
    def any(self) -> bool:
        return bool(self.columns)

    def hot(self, df: DataFrame | None = None) -> DataFrame:
        """The rows of the split keys."""
        return (self.df if df is None else df).where(F.col("range") != WHOLE)


def group_limit(total_rows: int, group_rows: int | None) -> int:
    return max(group_rows or GROUP_ROWS, total_rows // HOT_KEYS)


def split_hot_keys(
    df: DataFrame,
    keys: list[str],
    total_rows: int | None = None,
    group_rows: int | None = None,
    source: DataFrame | None = None,
    hot: dict[str, DataFrame | None] | None = None,
) -> Split:
    """Add a `range` column if some key has more than `group_rows` rows.

    `source` is a frame with the same keys and `seq` that is cheaper to compute;
    `hot` has the split keys of single columns, where `hot_keys` has found them
    already.
    """
    source = df if source is None else source
    if total_rows is None:
        total_rows = source.count()
    limit = group_limit(total_rows, group_rows)
    if total_rows <= limit:
        return Split(df)
    if hot is not None and len(keys) == 1:
        found = hot[keys[0]]
    else:
        found = settle(frequent_keys(source, keys, limit))
        found = None if found.isEmpty() else found
    if found is None:
        return Split(df)
    cuts = cut_points(source, -(-total_rows // limit), total_rows)
    # At most 2 * HOT_KEYS rows, see `frequent_keys`.
    marked = df.join(small_side(found.withColumn("is_hot", F.lit(True))), keys, "left")
    number = F.when(F.col("is_hot"), range_number(cuts, df.schema["seq"].dataType.simpleString()))
    return Split(marked.withColumn("range", number.otherwise(WHOLE)).drop("is_hot"), ["range"])


def split_all_keys(
    df: DataFrame, source: DataFrame, source_rows: int, most_rows: int, group_rows: int | None = None
) -> Split:
    """Add a `range` column for all keys, for frames with a few keys of which any may be large.

    `df` has `most_rows` rows at most and takes its order from `source`, on which
    the cut points are found.
    """
    limit = group_limit(most_rows, group_rows)
    if most_rows <= limit:
        return Split(df)
    cuts = cut_points(source, -(-most_rows // limit), source_rows)
    return Split(df.withColumn("range", range_number(cuts, df.schema["seq"].dataType.simpleString())), ["range"])


def hot_keys(
    df: DataFrame, columns: list[str], total_rows: int, group_rows: int | None = None
) -> dict[str, DataFrame | None]:
    """For each of some text columns its keys to be split, None where there is none; in one pass."""
    limit = group_limit(total_rows, group_rows)
    if total_rows <= limit:
        return dict.fromkeys(columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("key")) for c in columns])
    found = settle(frequent_keys(df.select(F.inline(pairs)), ["column", "key"], limit))
    present = {row["column"] for row in found.select("column").distinct().collect()}
    return {c: found.where(F.col("column") == c).select(F.col("key").alias(c)) if c in present else None for c in columns}


def frequent_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The keys with more than `limit` rows, and maybe some with more than half as many.

    Counted on a sample in which such a key has some thousand rows. Whether a
    key is split or not changes no result. Keys with half of `limit` rows and
    more are no more than 2 * total / limit.
    """
    share = min(1.0, SAMPLED_KEY_ROWS / limit)
    rows = df.select(*keys)
    if share == 1:
        return rows.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)
    return (
        rows.sample(share).groupBy(*keys).count().where(F.col("count") > SAMPLED_KEY_ROWS // 2).select(*keys)
    )


def cut_points(df: DataFrame, ranges: int, total_rows: int) -> list:
    """Values of `seq` that cut the rows into about equal ranges.

    Where to cut is taken from a sample, as range partitioning does; any cut
    gives the same results.
    """
    wanted = SAMPLED_RANGE_ROWS * ranges
    seqs = df.select("seq")
    if total_rows > wanted:
        seqs = seqs.sample(wanted / total_rows)
    shares = [i / ranges for i in range(1, ranges)]
    row = seqs.agg(F.percentile_approx("seq", shares, max(10_000, 10 * ranges)).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def range_number(cuts: list, order_type: str) -> Column:
    """Number of cut points at or below `seq`, by bisection."""
    if not cuts:
        return F.lit(0)
    points = F.expr(f"cast(split('{','.join(str(c) for c in cuts)}', ',') as array<{order_type}>)")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda position, step: F.when(
            F.get(points, position + step - 1) <= F.col("seq"), position + step
        ).otherwise(position),
    )
