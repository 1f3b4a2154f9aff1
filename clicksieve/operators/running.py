"""Running values over a key in arrival order, also for keys of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.operators.skew import WHOLE, Split
from clicksieve.session import settle, small_side

# State of a key whose value was cleared; no event has this timestamp.
CLEARED = -(2**63)


def up_to_now(columns: list[str], order: list[str]):
    return Window.partitionBy(*columns).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def group_columns(split: Split, scope: list[str]) -> list[str]:
    """Columns of one group; in an order whose sort also serves groups of the first key alone."""
    return [scope[0], *split.columns, *scope[1:]]


def running_sums(
    split: Split,
    scope: list[str],
    steps: dict[str, Column],
    reset: Column | None = None,
    order: tuple[str, ...] = ("seq",),
    together: str | None = None,
) -> DataFrame:
    """Add one running sum per entry of `steps`, over `scope` in `order`.

    A row for which `reset` holds starts its sums from zero. Without resets
    several rows may share a `seq` as long as `order` tells them apart. Rows are
    shuffled by `together` where given, a column of `scope` that a later step
    groups by.
    """
    columns = group_columns(split, scope)
    window = up_to_now(columns, list(order))

    def local(df: DataFrame) -> DataFrame:
        if together:
            df = df.repartition(together, *split.columns)
        df = df.withColumns({name: F.sum(step).over(window) for name, step in steps.items()})
        if reset is not None:
            base = {f"{name}_base": F.when(reset, F.col(name) - step) for name, step in steps.items()}
            df = df.withColumns({name: F.last(value, True).over(window) for name, value in base.items()})
        return df

    def own(name: str) -> Column:
        """The sum within the range: from its start or its last reset."""
        if reset is None:
            return F.col(name)
        return F.col(name) - F.coalesce(F.col(f"{name}_base"), F.lit(0))

    if not split.any:
        df = local(split.df)
        return df.select(*split.df.columns, *[own(name).alias(name) for name in steps])

    counted, since, resets = split.hot(), F.lit(True), F.lit(0)
    if reset is not None:
        # No more rows than boundaries.
        last_reset = settle(counted.where(reset).groupBy(*columns).agg(F.max("seq").alias("_reset")))
        counted = counted.join(small_side(last_reset), columns, "left")
        since = F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset"))
        resets = F.max(F.col("_reset").isNotNull().cast("int"))
    totals = counted.groupBy(*columns).agg(
        *[F.sum(F.when(since, step).otherwise(0)).alias(name) for name, step in steps.items()],
        resets.alias("resets"),
    )
    carried = settle(carry(totals, scope, split.columns, list(steps)))
    df = local(split.df).join(small_side(carried), columns, "left")

    def whole(name: str) -> Column:
        brought = F.coalesce(F.col(f"{name}_carry"), F.lit(0))
        if reset is not None:
            brought = F.when(F.col(f"{name}_base").isNull(), brought).otherwise(0)
        return own(name) + brought

    return df.select(*split.df.columns, *[whole(name).alias(name) for name in steps])


def carry(totals: DataFrame, scope: list[str], ranges: list[str], names: list[str]) -> DataFrame:
    """What each range of a key brings along from the ranges before it."""
    in_order = Window.partitionBy(*scope).orderBy(*ranges)
    since_reset = up_to_now([*scope, "epoch"], ranges)
    df = totals.withColumn("epoch", F.sum("resets").over(in_order))
    for name in names:
        df = df.withColumn(f"{name}_total", F.sum(name).over(since_reset))
    return df.select(
        *scope, *ranges, *[F.lag(f"{name}_total").over(in_order).alias(f"{name}_carry") for name in names]
    )


def last_value(split: Split, scope: list[str], value: Column, cleared: Column, name: str) -> DataFrame:
    """Add the latest non-null `value` (a long) of `scope`, forgotten at rows where `cleared` holds."""
    columns = group_columns(split, scope)
    window = up_to_now(columns, ["seq"])
    mark = F.coalesce(value, F.when(cleared, F.lit(CLEARED)))

    def visible(state: Column) -> Column:
        return F.when(state != CLEARED, state).alias(name)

    df = split.df.withColumn("_state", F.last(mark, True).over(window))
    if not split.any:
        return df.select(*split.df.columns, visible(F.col("_state")))

    last_mark = F.max_by(mark, F.when(mark.isNotNull(), F.col("seq")))
    before = Window.partitionBy(*scope).orderBy(*split.columns).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        split.hot()
        .groupBy(*columns)
        .agg(last_mark.alias("_last"))
        .select(*columns, F.last("_last", True).over(before).alias("_carry"))
    )
    df = df.join(small_side(settle(carried)), columns, "left")
    return df.select(*split.df.columns, visible(F.coalesce("_state", "_carry")))


def first_time(split: Split, df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """Add the smallest `seq` at which `condition` holds for `key`, null if it never does.

    `df` is `split.df` with further columns and has the same partitioning.
    """
    found = F.when(condition, F.col("seq"))
    group = Window.partitionBy(key, *split.columns)
    if not split.any:
        return df.withColumn(name, F.min(found).over(group))
    # One row per split key, and `split_hot_keys` bounds these.
    # The condition stands inside the aggregate: so the exchange of `df` is used again.
    hot = df.groupBy(key).agg(F.min(F.when(F.col("range") != WHOLE, found)).alias("_first")).where("_first is not null")
    return (
        df.withColumn(name, F.min(found).over(group))
        .join(F.broadcast(hot), key, "left")
        .withColumn(name, F.when(F.col("range") == WHOLE, F.col(name)).otherwise(F.col("_first")))
        .drop("_first")
    )
