"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the n-grams a text repeats; a
text is rejected when too many of its characters lie inside repeated n-grams or
repeated lines. Word counts of the base rules come from the same pass.

Results in special cases: a null or empty text, or one of white space, has no
words and fails the base rules. Lines count as equal only if every character
is. Rows are measured one by one, so repeated rows and ties need no care, an
empty table gives an empty table, and other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lengths, in words, of the n-grams whose repetition is measured.
LENGTHS = (5, 6, 7, 8, 9, 10)
# Share of the word characters that repeated n-grams of one length, and
# repeated lines, may hold.
MAX_NGRAM_SHARE = 0.3
MAX_LINE_SHARE = 0.3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

MEASURES = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(name, T.DoubleType()) for name in ("ngram_share", "line_share")]
)

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _scatter(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, different ones staying different."""
    mixed = (numbers.astype(np.uint64) + np.uint64(1)) * _FACTOR
    mixed ^= mixed >> np.uint64(29)
    return mixed * _BASE


def _equal_windows(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: is its code found elsewhere, and is it found earlier."""
    order = np.argsort(codes, kind="stable")
    follows = np.zeros(len(codes), bool)
    follows[1:] = codes[order][1:] == codes[order][:-1]
    repeated = follows.copy()
    repeated[:-1] |= follows[1:]
    found, earlier = np.empty(len(codes), bool), np.empty(len(codes), bool)
    found[order], earlier[order] = repeated, follows
    return found, earlier


def _covered(marked: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """The words that lie inside a marked window."""
    edges = np.zeros(n_words + 1, np.int64)
    edges[: len(marked)] += marked
    edges[length : length + len(marked)] -= marked
    return np.cumsum(edges[:n_words]) > 0


def measure(text: str | None, lengths: tuple[int, ...] = LENGTHS) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    n_chars = len(text) - sum(map(text.count, WHITE))
    n_symbols = sum(map(text.count, SYMBOLS))

    seen, n_dup_lines, dup_line_chars = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += len(line) - sum(map(line.count, WHITE))
            seen.add(line)

    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n_words)
    n_repeat_words, share = 0, 0.0
    if n_words >= 3:
        # Exact codes of pairs, then of triples: no two windows share one by chance.
        _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        found, _ = _equal_windows(pairs[:-1].astype(np.int64) * len(numbers) + ids[2:])
        n_repeat_words = int(_covered(found, 3, n_words).sum())
    if n_repeat_words:
        # Windows of five words or more repeat only where windows of three do.
        sizes = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n_words)
        letters = _scatter(ids)
        rolled = letters
        for length in range(2, min(max(lengths), n_words) + 1):
            rolled = rolled[:-1] * _BASE + letters[length - 1 :]
            if length in lengths:
                _, earlier = _equal_windows(rolled)
                share = max(share, float(sizes[_covered(earlier, length, n_words)].sum()) / n_chars)
    return n_words, n_chars, n_symbols, n_dup_lines, n_repeat_words, share, dup_line_chars / max(n_chars, 1)


@F.pandas_udf(MEASURES)
def measures(texts: pd.Series) -> pd.DataFrame:
    """The measures of each text, as one struct column."""
    return pd.DataFrame([measure(text) for text in texts], columns=MEASURES.names)


def base_failed(found: Column) -> Column:
    return (found["n_words"] < MIN_WORDS) | (
        100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"]
    )


def repetition_ok(found: Column) -> Column:
    return (found["ngram_share"] <= MAX_NGRAM_SHARE) & (found["line_share"] <= MAX_LINE_SHARE)


def rate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measures, and whether the rules keep it."""
    found = F.col("found")
    return docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("found")).select(
        "doc_id",
        "found.*",
        base_failed(found).alias("base_failed"),
        (~base_failed(found) & repetition_ok(found)).alias("kept"),
    )
