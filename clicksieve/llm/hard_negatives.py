"""Hard negatives by Fagin's threshold algorithm.

For an anchor and one of its positives, the nearest rows of the same label, the
hard negatives are the rows of other labels whose score lies in a window below
the positive's. Scores are inner products of whole-number vectors.

Rows are dealt into blocks and anchors into sets, and each pair of these is a
group of its own. A group has one list per dimension, its rows in order of the
component. An anchor goes down all lists at once, from the end that its own sign
in the dimension makes the better one. A row met for the first time is scored
whole by random access. What the lists have come to bounds the score of every
row not met yet; an anchor stops once this threshold falls strictly below the
worst of the wanted rows of each of its windows, or below the window itself. The
best of all groups are merged per anchor: first the positives, then, with the
windows they give, the negatives. Anchors are a stated query set that meets all
rows, in blocks.

Results in special cases: rows with a null label or vector, or with a component
that is null or not finite, take no part; components are taken as
floor(scale * x), at the ends of a long where that is beyond it, and a score
likewise; vectors of different lengths are compared as if the shorter ended in
zeros. A row without an id is no anchor and comes after all others in ties. Rows
of one id are rows of their own: another row with the anchor's id can be its
positive or negative, and repeated anchors each have results. An anchor without
positives, or a window without rows, gives nothing, and so does an empty table;
other columns are not looked at.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.session import settle

# Python workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITIVES = 5
NEGATIVES = 5
# A negative has this share of its positive's score at least, in percent, and all of it at most.
LOW_PERCENT = 80
# Steps that a component of 1 makes.
SCALE = 256
# Rows and anchors of one group.
BLOCK_ROWS = 4096
ANCHOR_ROWS = 256
# Places of each list that an anchor takes first; every further step is twice as long.
FIRST_STEP = 32

LONG = np.iinfo(np.int64)
NO_ID = int(LONG.max)
FOUND = "anchor long, low long, high long, row long, id long, score long"


class Lists:
    """The rows of a block: whole for random access, and sorted by each dimension."""

    def __init__(self, vectors: list, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, dims: int, most: int):
        """`most` is the largest size of any component that they will be scored with."""
        self.ids, self.labels, self.rows = ids, labels, rows
        whole = np.zeros((len(vectors), dims), np.int64)
        for i, vector in enumerate(vectors):
            whole[i, : len(vector)] = vector
        bound = dims * most * max((abs(int(x)) for x in (whole.min(initial=0), whole.max(initial=0))), default=0)
        # Whole numbers of these sizes are exact as floating point; others are numbers of any size.
        self.kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
        self.values = whole.astype(self.kind)
        self.order = np.argsort(whole, axis=0, kind="stable").T.copy()

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[list[tuple]]:
        """For each window of scores the first `k` allowed rows in it, as (score, row number), best first."""
        n = len(self.values)
        dims = np.flatnonzero(anchor)
        whole = anchor.astype(self.kind)
        weights = whole[dims]
        rising = (anchor[dims] < 0)[:, None]
        met = np.zeros(n, bool)
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, self.kind), np.zeros(0, np.int64))] * len(windows)
        depth, step = 0, FIRST_STEP
        while True:
            until = min(depth + step, n)
            if len(dims):
                lists = self.order[dims]
                reached = np.where(rising, lists[:, depth:until], lists[:, n - until : n - depth][:, ::-1])
                now = np.zeros(n, bool)
                now[reached] = True
                now &= ~met
                # No row not met yet has a better component in any list.
                threshold = self.within_long((self.values[reached[:, -1], dims] * weights).sum())
            else:
                now, until, threshold = ~met, n, 0
            met |= now
            fresh = np.flatnonzero(now & allowed)
            scores = self.within_long(self.values[fresh] @ whole)
            for w, (low, high) in enumerate(windows):
                inside = np.ones(len(fresh), bool) if low is None else (scores >= low) & (scores <= high)
                if inside.any():
                    kept[w] = self.first(np.append(kept[w][0], scores[inside]), np.append(kept[w][1], fresh[inside]), k)
            over = [
                (low is not None and threshold < low) or (len(found) == k and threshold < found[-1])
                for (low, _), (found, _) in zip(windows, kept, strict=True)
            ]
            depth, step = until, 2 * step
            if depth >= n or all(over):
                return [[(int(s), int(r)) for s, r in zip(*found, strict=True)] for found in kept]

    def within_long(self, scores):
        return np.clip(scores, LONG.min, LONG.max) if self.kind is object else scores

    def first(self, scores: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` best by score, then id, then row."""
        if self.kind is not object and len(scores) > 8 * k:
            # Nothing below the k-th score can be among them.
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, at = scores[scores >= least], at[scores >= least]
        best = sorted(range(len(at)), key=lambda i: (-scores[i], self.ids[at[i]], self.rows[at[i]]))[:k]
        return scores[best], at[best]


def search_block(same_label: bool, k: int):
    """Searches the rows of a block for its set of anchors."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(anchors):
            own = [np.asarray(v, np.int64) for v in anchors["anchor_vector"]]
            dims = max(max(map(len, own)), max(map(len, rows["vector"])))
            most = max((abs(int(x)) for v in own for x in v), default=0)
            ids, labels, numbers = (rows[c].to_numpy(np.int64) for c in ("id", "label", "row"))
            lists = Lists(list(rows["vector"]), ids, labels, numbers, dims, most)
            for i, (number, label, windows) in enumerate(anchors[["anchor_row", "anchor_label", "windows"]].itertuples(index=False)):
                anchor = np.zeros(dims, np.int64)
                anchor[: len(own[i])] = own[i]
                allowed = (labels == label) & (numbers != number) if same_label else labels != label
                if not allowed.any():
                    continue
                # Without windows, all scores are in one.
                ranges = [(w["low"], w["high"]) for w in windows] if windows is not None else [(None, None)]
                for (low, high), best in zip(ranges, lists.search(anchor, allowed, ranges, k), strict=True):
                    found += [(number, low, high, numbers[r], ids[r], s) for s, r in best]
        columns = ["anchor", "low", "high", "row", "id", "score"]
        return pd.DataFrame(found, columns=columns).astype({"low": "Int64", "high": "Int64"})

    return run


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, scale: int = SCALE) -> DataFrame:
    """row, id, label, vector of whole numbers, whether an anchor; of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(label_col).alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v)).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )


def search(rows: DataFrame, anchors: DataFrame, same_label: bool, k: int, n_blocks: int, n_sets: int) -> DataFrame:
    """The first `k` rows of every window of every anchor: anchor, low, high, row, id, score."""
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks))
    part = F.pmod(F.xxhash64("row"), F.lit(n_sets))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # As many tasks as groups: these are small in bytes but not in work.
    key, groups = ["block", "part"], n_blocks * n_sets
    dealt = rows.select("row", "id", "label", "vector", block.alias("block"), each(n_sets).alias("part"))
    asked = anchors.select(
        *[F.col(c).alias(f"anchor_{c}") for c in ("row", "label", "vector")], "windows", part.alias("part"), each(n_blocks).alias("block")
    )
    found = (
        dealt.repartition(groups, *key).groupBy(*key)
        .cogroup(asked.repartition(groups, *key).groupBy(*key))
        .applyInPandas(search_block(same_label, k), FOUND)
    )
    best = Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    is_anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """For each anchor and positive the hard negatives, best first.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score. All
    rows are anchors unless `is_anchor` says which.
    """
    every = F.lit(True) & F.col(id_col).isNotNull()
    whole = settle(whole_vectors(rows, id_col, vector_col, label_col, every if is_anchor is None else every & is_anchor))
    counted = whole.agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    n_blocks, n_sets = max(1, -(-counted["rows"] // block_rows)), max(1, -(-counted["anchors"] // anchor_rows))
    anchors = whole.where("is_anchor")
    unbounded = anchors.withColumn("windows", F.lit(None).cast("array<struct<low: long, high: long>>"))
    near = settle(
        search(whole, unbounded, True, positives, n_blocks, n_sets).select("anchor", F.col("id").alias("positive"), F.col("score").alias("high"))
    )
    # The least whole number that is no smaller than the share.
    share = F.col("high").cast("decimal(19,0)") * F.lit(low_percent).cast("decimal(9,0)")
    low = F.call_function("div", share, F.lit(100).cast("decimal(3,0)")) + (share % 100 > 0).cast("long")
    windows = (
        near.select("anchor", low.alias("low"), "high").where("low <= high").distinct()
        .groupBy("anchor").agg(F.collect_list(F.struct("low", "high")).alias("windows"))
    )
    asked = anchors.join(windows.withColumnRenamed("anchor", "row"), "row")
    hard = search(whole, asked, False, negatives, n_blocks, n_sets).select("anchor", "high", "rank", F.col("id").alias("negative"), "score")

    def named(number: str) -> Column:
        return F.when(F.col(number) != NO_ID, F.col(number))

    return (
        near.join(hard, ["anchor", "high"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", named("positive").alias("positive_id"), "rank", named("negative").alias("negative_id"),
            F.col("high").alias("positive_score"), F.col("score").alias("negative_score"),
        )
    )
