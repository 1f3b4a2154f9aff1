"""Quality classifier: a linear model over n-gram indicators scaled by naive Bayes.

A text becomes the set of its n-grams: the words, and runs of one to three word
shapes (letter case, digits, closing sign, whether the word has just been
said). Indicators are scaled by the log-count ratio of the two classes, and a
linear hinge-loss model is fitted over them by dual coordinate descent. Margins
become probabilities by a logistic curve fitted on rows the model has not seen.

Labels are learned from a bounded sample of the labelled rows, MAX_LABELLED of
them at most in expectation, chosen by a hash of the id; scoring covers every
row and reads nothing but the text.

Results in special cases: null and empty texts hold one n-gram, which stands for
emptiness, and are scored like others; a row with several labels is learned
once for each; null labels and null ids are not learned from; without rows of
both classes every score is the share of good labels (a half where there are
none at all); an empty table gives an empty one; other columns, equal names
included, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 18
MAX_LABELLED = 12_000
SMOOTHING = 1.0
COST = 1.0
PASSES = 30
KEPT_FROM = 0.7
# Of four parts of the rows, by checksum of the id, this one is never learned from.
PARTS, HELD_OUT_PART = 4, 2

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1 << 16)
def _word(word: str) -> tuple[int, int]:
    """Hashes of a word and of its shape, the same on every machine."""
    core = word.strip(".,;:!?\"'()")
    if not core:
        case = "-"
    elif core.isupper() and len(core) > 1:
        case = "U"
    elif core[0].isupper():
        case = "C"
    elif core.isalpha():
        case = "l"
    else:
        case = "x"
    digit = "9" if any(c.isdigit() for c in word) else ""
    ending = "" if word[-1].isalnum() else word[-1]
    shape = f"{case}{digit}{ending}{'=' if len(word) > 2 and word[-2] == word[-1] else ''}"
    return _hash("w" + word.lower()), _hash("s" + shape)


def _hash(text: str) -> int:
    found = 0xCBF29CE484222325
    for byte in text.encode("utf-8", "surrogatepass"):
        found = (found ^ byte) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return found


_EMPTY = _hash("empty")


def ngrams(text: str | None) -> np.ndarray:
    """The buckets of a text's n-grams, each once."""
    words = (text or "").split()
    if not words:
        return np.array([_EMPTY >> 46], np.int64)
    pairs = np.array([_word(w) for w in words], np.uint64)
    names, shapes = pairs[:, 0], pairs[:, 1].copy()
    shapes[1:] += (names[1:] == names[:-1]).astype(np.uint64) * np.uint64(7)
    runs, found = shapes, [names, shapes]
    for n in (2, 3):
        if len(words) < n:
            break
        runs = (runs[:-1] * _MIX) ^ (shapes[n - 1 :] + np.uint64(n))
        found.append(runs)
    mixed = np.concatenate(found) * _MIX
    return np.unique(mixed >> np.uint64(46)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # for each bucket, the log-count ratio times what was fitted
    norms: np.ndarray  # for each bucket, the square of its ratio
    bias: float
    slope: float
    offset: float

    def margin(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum() / max(np.sqrt(self.norms[buckets].sum()), 1e-9) + self.bias)

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(ngrams(text)) + self.offset, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.full((2, BUCKETS), SMOOTHING)
    for buckets, label in zip(rows, good.astype(int), strict=True):
        counts[label, buckets] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, seed: int = 3) -> np.ndarray:
    """Weights and bias (last) of the hinge-loss model over rows of unit length, by its dual."""
    weights = np.zeros(BUCKETS + 1)
    alphas = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(PASSES):
        change = 0.0
        for i in order.permutation(len(rows)):
            buckets, values = rows[i]
            gradient = signs[i] * (weights[buckets] @ values + weights[-1]) - 1.0
            # Every row has length 1, and 1 more for the bias.
            alpha = min(max(alphas[i] - gradient / 2.0, 0.0), costs[i])
            step = (alpha - alphas[i]) * signs[i]
            if step:
                weights[buckets] += step * values
                weights[-1] += step
                change = max(change, abs(step))
                alphas[i] = alpha
        if change < 1e-3:
            break
    return weights


def logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to probabilities, by Newton's method."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    at = np.array([1.0, 0.0])
    design = np.stack([margins, np.ones(len(margins))], axis=1)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * at)
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def train(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """A model of n-gram sets; `good` tells the rows of label 1."""
    empty = np.zeros(BUCKETS)
    if good.all() or not good.any():
        share = (good.sum() + 0.5) / (len(good) + 1.0)
        return Model(empty, empty, 0.0, 0.0, float(np.log(share / (1 - share))))

    def fit(chosen: np.ndarray) -> Model:
        ratio = log_count_ratio([rows[i] for i in chosen], good[chosen])
        # One large array, which goes back to the system afterwards; many small ones would not.
        ends = np.cumsum([len(rows[i]) for i in chosen])
        scaled, every = [], np.split(np.empty(ends[-1]), ends[:-1])
        for i, values in zip(chosen, every, strict=True):
            np.take(ratio, rows[i], out=values)
            values /= max(np.sqrt(values @ values), 1e-9)
            scaled.append((rows[i], values))
        # Rows of the rarer class weigh more, so that both classes count alike.
        share = good[chosen].mean()
        costs = COST * np.where(good[chosen], 0.5 / share, 0.5 / (1 - share))
        fitted = coordinate_descent(scaled, np.where(good[chosen], 1.0, -1.0), costs)
        return Model(ratio * fitted[:-1], ratio**2, float(fitted[-1]), 1.0, 0.0)

    # One row of five of each class is kept back for the curve.
    back = np.zeros(len(rows), bool)
    for label in (False, True):
        back[np.flatnonzero(good == label)[::5]] = True
    first, rest = np.flatnonzero(~back), np.flatnonzero(back)
    if good[first].all() or not good[first].any():
        first = rest = np.arange(len(rows))
    unseen = fit(first)
    slope, offset = logistic(np.array([unseen.margin(rows[i]) for i in rest]), good[rest])
    whole = fit(np.arange(len(rows)))
    return Model(whole.weights, whole.norms, whole.bias, slope, offset)


def part(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % PARTS, F.lit(-1))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def ngram_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([ngrams(text).astype(np.int32) for text in texts])


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """A model from the rows of `docs` with a label, the held-out part left out.

    About `max_labelled` rows at most come to the driver, as sets of n-grams.
    """
    usable = labels.select("doc_id", F.col(label_col).alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (part(F.col("doc_id")) != HELD_OUT_PART)
    )
    share = min(1.0, max_labelled / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # `chosen` holds max_labelled rows of two numbers, give or take chance.
    # Copies of a row neither come to the driver nor weigh more.
    joined = texts.join(F.broadcast(chosen), "doc_id").withColumn("digest", F.sha2("text", 256))
    once = joined.dropDuplicates(["doc_id", "label", "digest"])
    rows = once.select("doc_id", "label", "digest", ngram_sets("text").alias("ngrams"))
    found = rows.toArrow()
    order = pc.sort_indices(found, [(name, "ascending") for name in ("doc_id", "label", "digest")]).to_numpy()
    # The sets stay views of one array: as rows of pandas they took several times the room.
    sets = found["ngrams"].combine_chunks()
    buckets, offsets = sets.values.to_numpy(), sets.offsets.to_numpy()
    good = found["label"].to_numpy().astype(np.int64) == 1
    del found, sets
    return train([buckets[offsets[i] : offsets[i + 1]] for i in order], good[order])


def score(docs: DataFrame, model: Model, text: Column) -> Column:
    """The score of a text column of `docs`: how likely its label is 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of BUCKETS numbers

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = learn(docs, labels)
    return docs.select(
        "doc_id", (part(F.col("doc_id")) == HELD_OUT_PART).alias("held_out"), score(docs, model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= KEPT_FROM).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns."""
    return docs.where(score(docs, learn(docs, labels), F.col("text")) >= KEPT_FROM)
