"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are rows of lower-case word tokens. Runs of
MIN_MATCH tokens that both share are seeds; joining on them leaves few pairs of
document and item. In those, the longest match of unmarked tokens is marked
again and again, found by Karp-Rabin hashes of windows whose length runs down
to MIN_MATCH, so that tiles never overlap and passages put in another order
still cover the item. A document is contaminated when tiles cover at least
MIN_COVERAGE of an item.

The benchmark is taken in blocks of bounded size, each joined to all documents;
documents are never shuffled. A pair is tiled only if the tokens of the item
that lie in seeds, which bound what tiles can cover, reach the threshold.

Results in special cases: null and empty documents match nothing; items of fewer
tokens than MIN_MATCH, which any text may hold by chance, match only documents of
the same tokens; items without tokens match nothing; of equal items, equal documents and repeated rows each gives its own row; of equally
long matches the first in the item, then in the document, is marked; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_MATCH = 4
MIN_COVERAGE = 0.5
# Bytes of benchmark text that are sent to the executors at a time.
BLOCK_BYTES = 16 << 20

_TOKEN = re.compile(r"\w+")
_BASE, _WRAP = 0x9E3779B97F4A7C15, 1 << 64

HIT = "array<struct<item_id: long, n_tokens: int, covered: int, coverage: double, tiles: array<struct<item_at: int, doc_at: int, length: int>>>>"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _windows(codes: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of the windows of unmarked tokens: (start, hash)."""
    if len(codes) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # Horner's rule over doubling lengths gives all windows in a few passes.
    hashes, done, power = codes, 1, _BASE
    for bit in bin(length)[3:]:
        hashes = hashes[: len(hashes) - done] * np.uint64(power) + hashes[done:]
        done, power = done * 2, power * power % _WRAP
        if bit == "1":
            hashes = hashes[: len(hashes) - 1] * np.uint64(_BASE) + codes[done : done + len(hashes) - 1]
            done, power = done + 1, power * _BASE % _WRAP
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[length:] == taken[:-length])
    return at, hashes[at]


def _longest(item: np.ndarray, doc: np.ndarray, free_item: np.ndarray, free_doc: np.ndarray, length: int) -> tuple[int, int, int] | None:
    """The longest match of at least `length` unmarked tokens: (item_at, doc_at, length)."""
    item_at, item_hash = _windows(item, free_item, length)
    doc_at, doc_hash = _windows(doc, free_doc, length)
    order = np.argsort(doc_hash, kind="stable")
    low = np.searchsorted(doc_hash, item_hash, "left", sorter=order)
    high = np.searchsorted(doc_hash, item_hash, "right", sorter=order)
    best = None
    for k in np.flatnonzero(high > low):
        i = int(item_at[k])
        for j in doc_at[order[low[k] : high[k]]].tolist():
            if best and (i + best[2] >= len(item) or j + best[2] >= len(doc) or item[i + best[2]] != doc[j + best[2]]):
                continue  # can't be longer than the best
            n = 0
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                n += 1
            if n >= length and (best is None or n > best[2]):
                best = (i, j, n)
    return best


def tile(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (item_at, doc_at, length) of two rows of token codes, the longest first."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    found, length = [], max(min(len(item), len(doc)), min_match)
    while True:
        best = _longest(item, doc, free_item, free_doc, length)
        if best:
            i, j, n = best
            free_item[i : i + n] = free_doc[j : j + n] = False
            found.append(best)
            # Nothing longer than this one is left, and it was the longest.
            length = min(length, n)
        elif length > min_match:
            length = max(length // 2, min_match)
        else:
            return found


class Block:
    """A part of the benchmark, with its seeds; sent to the executors."""

    def __init__(self, items: list[tuple[int, str]], min_match: int, min_coverage: float):
        self.min_match, self.min_coverage = min_match, min_coverage
        self.codes: dict[str, int] = {}  # token -> 1, 2, ...; 0 is any other
        self.items: list[tuple[int, np.ndarray, int]] = []
        seeds = defaultdict(list)
        for item_id, text in items:
            row = np.array([self.codes.setdefault(t, len(self.codes) + 1) for t in tokens(text)], np.uint64)
            if not len(row):
                continue
            n = min(min_match, len(row))
            for at in range(len(row) - n + 1):
                seeds[n, tuple(row[at : at + n].tolist())].append((len(self.items), at))
            self.items.append((item_id, row, n))
        # For each seed length: sorted hashes, and where the occurrences of each begin.
        self.seeds: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]] = {}
        by_length = defaultdict(dict)
        for (n, run), places in seeds.items():
            hashed = _windows(np.array(run, np.uint64), np.ones(n, bool), n)[1][0]
            by_length[n].setdefault(hashed, []).extend(places)
        for n, table in by_length.items():
            hashes = np.array(sorted(table), np.uint64)
            self.seeds[n] = hashes, [table[h] for h in hashes]

    def hits(self, text: str | None) -> list[tuple]:
        """Every item that the tiles of a text cover well enough."""
        get = self.codes.get
        doc = np.fromiter((get(t, 0) for t in tokens(text)), np.uint64)
        known = doc > 0
        in_seeds: dict[int, set[int]] = defaultdict(set)
        for n, (hashes, places) in self.seeds.items():
            _, windows = _windows(doc, known, n)
            windows = np.unique(windows)
            at = np.minimum(np.searchsorted(hashes, windows), len(hashes) - 1)
            for k in at[hashes[at] == windows]:
                for item, start in places[k]:
                    in_seeds[item].update(range(start, start + n))
        out = []
        for index in sorted(in_seeds):
            item_id, item, n = self.items[index]
            if len(in_seeds[index]) < self.min_coverage * len(item):
                continue
            if n < self.min_match and len(doc) != len(item):
                continue
            tiles = tile(item, doc, n)
            covered = sum(t[2] for t in tiles)
            if covered >= self.min_coverage * len(item):
                out.append((item_id, len(item), covered, covered / len(item), tiles))
        return out


def blocks(benchmark: DataFrame, block_bytes: int | None = None) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about `block_bytes`, dealt by hash."""
    block_bytes = block_bytes or BLOCK_BYTES
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item_id"], r["text"]) for r in items.where(block == k).orderBy("item_id", "text").collect()]


def hit_columns(spark, benchmark: DataFrame, text: Column, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE) -> list[Column]:
    """For each block of the benchmark, a column of the hits of a text in it."""

    def column(items: list[tuple[int, str]]) -> Column:
        shared = spark.sparkContext.broadcast(Block(items, min_match, min_coverage))

        @F.pandas_udf(HIT)
        def hits(texts: pd.Series) -> pd.Series:
            return pd.Series([shared.value.hits(t) for t in texts], dtype=object)

        return hits(text)

    return [column(items) for items in blocks(benchmark)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """A row for each document and benchmark item that it contains: doc_id, item_id, coverage and tiles."""
    text = docs.select("doc_id", "text")
    found = [
        text.select("doc_id", F.explode(hits).alias("hit")).select("doc_id", "hit.*")
        for hits in hit_columns(docs.sparkSession, benchmark, F.col("text"), min_match, min_coverage)
    ]
    return reduce(DataFrame.unionByName, found)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    for hits in hit_columns(docs.sparkSession, benchmark, F.col("text")):
        docs = docs.where(F.size(hits) == 0)
    return docs
