"""Line dedup by a sharded minimal perfect hash.

Documents are reduced to the 128-bit hashes of their lines' keys. Hashes that
several documents hold are dealt into shards of bounded size, and every shard
becomes a few arrays: a minimal perfect hash gives each of its n hashes a place
of its own below n, at which stand a fingerprint of 64 bits, the number of
holders and the smallest document. Hashes of a single document can lose no line
and are left out; the fingerprint, which with the place makes up the whole hash,
tells them apart from what is in the shard.

Documents then look their lines up in the arrays; no text is shuffled for it.
Shards that have `limit` bytes together at most are broadcast. Otherwise the
hashes (not the lines) go to the arrays of their shard, which are copied for as
many groups as the shard's hashes fill, so that a line that every document has
spreads over many tasks, and what is to be dropped goes back to the documents.

Results in special cases: a null or empty text is one empty line, which stays; a
text of which all lines go becomes empty; of the equal lines of the document
that keeps a key all stay. Rows of one id are one document, and rows without an
id are one that comes after all others; each row is returned. An empty table
gives an empty one, and other columns are not looked at. Ids are whole numbers
below 2^63 - 1.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.common import keyed_text
from clicksieve.session import BROADCAST_BYTES, measured_bytes, settle, small_side

# Python workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Code points a key must have for its lines to be dropped, and documents it must be in.
MIN_CHARS = 10
MIN_DOCUMENTS = 2
# Hashes of a shard, about, and looked up in one group.
SHARD_HASHES = 1 << 16
GROUP_HASHES = 1 << 20
# Text that is looked up at once, in characters.
TOGETHER = 1 << 22

WHITE = b" \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1
# Bits for each hash that a level still has to place.
SPREAD = 2

HASHES = "high long, low long"
KEPT = "id long, text string, n_lines long, n_dropped long"
SHARD = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary, owners binary"


def line_key(line: bytes) -> bytes | None:
    """What makes lines equal; None where the line always stays."""
    key = line.strip(WHITE).lower()
    if len(key) < MIN_CHARS or len(key) < 4 * MIN_CHARS and len(key.decode("utf-8", "replace")) < MIN_CHARS:
        return None
    return key


def hashes(keys: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the keys' hashes."""
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">i8").astype(np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _slots(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where a level would have each hash."""
    mixed = high.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.view(np.uint64)
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed + np.uint64(level)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


@dataclass
class Places:
    """A minimal perfect hash: levels of bits, of which each set one is the place of one hash."""

    sizes: list[int]
    # The bits of all levels, 64 to a word.
    words: np.ndarray

    def __post_init__(self) -> None:
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> Places:
        """The places of different hashes."""
        left, sizes, levels = np.arange(len(high)), [], []
        while len(left):
            size = -(-SPREAD * len(left) // 64) * 64
            slots = _slots(high[left], low[left], len(sizes), size)
            held = np.bincount(slots, minlength=size)
            levels.append(np.packbits(held == 1, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[held[slots] != 1]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint64))

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each hash; of one that was not there any place, or -1."""
        found, left, start = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            slots = _slots(high[left], low[left], level, size) + start
            words, bits = self.words[slots >> 6], (slots & 63).astype(np.uint64)
            there = (words >> bits & np.uint64(1)).astype(bool)
            below = words & ((np.uint64(1) << bits) - np.uint64(1))
            found[left[there]] = (self.before[slots >> 6] + np.bitwise_count(below))[there]
            left, start = left[~there], start + size
        return found


@dataclass
class Shard:
    """The places of a shard's hashes, and what stands at them."""

    places: Places
    fingerprints: np.ndarray
    counts: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> Shard:
        places = Places.of(high, low)
        order = np.argsort(places.find(high, low))
        return cls(places, low[order], counts[order], owners[order])

    @classmethod
    def read(cls, row) -> Shard:
        places = Places(list(row["sizes"]), np.frombuffer(row["bits"], np.uint64))
        fields = [np.frombuffer(row[name], np.int64) for name in ("fingerprints", "counts", "owners")]
        return cls(places, *fields)

    def written(self) -> dict:
        arrays = {"bits": self.places.words, "fingerprints": self.fingerprints, "counts": self.counts, "owners": self.owners}
        return {"sizes": self.places.sizes} | {name: array.tobytes() for name, array in arrays.items()}

    def dropped(self, high: np.ndarray, low: np.ndarray, ids: np.ndarray, least: int) -> np.ndarray:
        """Whether each hash is one that another document keeps."""
        at = self.places.find(high, low)
        known = at >= 0
        known[known] = self.fingerprints[at[known]] == low[known]
        at = at[known]
        known[known] = (self.counts[at] >= least) & (self.owners[at] != ids[known])
        return known


def document_hashes(docs: DataFrame) -> DataFrame:
    """id, text_hash, text -> a row for each different key of a text: id, text_hash, and both halves of the key's hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch["text"]):
                keys, sizes = [], []
                for lines in _lines(batch["text"].iloc[part]):
                    found = dict.fromkeys(map(line_key, lines))
                    found.pop(None, None)
                    keys += found
                    sizes.append(len(found))
                high, low = hashes(keys)
                names = {name: np.repeat(batch[name].to_numpy(np.int64)[part], sizes) for name in ("id", "text_hash")}
                yield pd.DataFrame(names | {"high": high, "low": low})

    return docs.mapInPandas(run, f"id long, text_hash long, {HASHES}")


def _lines(texts: Iterable[str]) -> list[list[bytes]]:
    return [text.encode("utf-8", "surrogatepass").split(b"\n") for text in texts]


def _parts(texts: pd.Series) -> Iterator[slice]:
    """Slices of texts with about `TOGETHER` characters."""
    ends = np.cumsum(texts.str.len().to_numpy(np.int64))
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, TOGETHER + (ends[start - 1] if start else 0))))
        yield slice(start, stop)
        start = stop


def build_shards(hashed: DataFrame, min_documents: int = MIN_DOCUMENTS, shard_hashes: int = SHARD_HASHES) -> tuple[DataFrame, int]:
    """The arrays of the hashes that several documents hold, a row for each shard, and the number of shards."""
    # Two documents are told by the smallest and the largest id, more of them have to be counted.
    n = F.count("*") if min_documents <= 2 else F.count_distinct("id")
    held = hashed.groupBy("high", "low").agg(F.min("id").alias("owner"), F.max("id").alias("last"), n.alias("n"))
    repeated = settle(held.where((F.col("owner") < F.col("last")) & (F.col("n") >= min_documents)).drop("last"))
    n_shards = max(1, -(-repeated.count() // shard_hashes))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        columns = [rows[name].to_numpy(np.int64) for name in ("high", "low", "n", "owner")]
        return pd.DataFrame([{"shard": rows["shard"].iloc[0]} | Shard.of(*columns).written()])

    dealt = repeated.withColumn("shard", F.pmod("high", F.lit(n_shards)))
    return settle(dealt.groupBy("shard").applyInPandas(build, SHARD)), n_shards


def look_up(docs: DataFrame, shards: DataFrame, n_shards: int, min_documents: int) -> DataFrame:
    """Documents without their dropped lines, by arrays that every task has."""
    arrays = shards.sparkSession.sparkContext.broadcast([row.asDict() for row in shards.collect()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {row["shard"]: Shard.read(row) for row in arrays.value}
        for batch in batches:
            ids = batch["id"].to_numpy(np.int64)
            for part in _parts(batch["text"]):
                lines = _lines(batch["text"].iloc[part])
                keys = [line_key(line) for document in lines for line in document]
                at = np.array([i for i, key in enumerate(keys) if key is not None], np.int64)
                high, low = hashes(key for key in keys if key is not None)
                owners = np.repeat(ids[part], list(map(len, lines)))[at]
                drop = np.zeros(len(keys), bool)
                shard = high % n_shards
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                for rows in np.split(order, cuts) if len(order) else []:
                    if (arrays_of := known.get(int(shard[rows[0]]))) is not None:
                        drop[at[rows]] = arrays_of.dropped(high[rows], low[rows], owners[rows], min_documents)
                yield _kept(ids[part], lines, drop)

    return docs.select("id", "text").mapInPandas(run, KEPT)


def _kept(ids: np.ndarray, lines: list[list[bytes]], drop: np.ndarray) -> pd.DataFrame:
    texts, dropped, start = [], [], 0
    for document in lines:
        gone = drop[start : start + len(document)]
        start += len(document)
        kept = [line for line, out in zip(document, gone.tolist(), strict=True) if not out]
        texts.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
        dropped.append(len(document) - len(kept))
    return pd.DataFrame({"id": ids, "text": texts, "n_lines": [len(document) for document in lines], "n_dropped": dropped})


def look_up_by_shard(
    docs: DataFrame, hashed: DataFrame, shards: DataFrame, n_shards: int, min_documents: int, group_hashes: int = GROUP_HASHES
) -> DataFrame:
    """Documents without their dropped lines; each hash is looked up where the arrays of its shard are."""
    probes = hashed.withColumn("shard", F.pmod("high", F.lit(n_shards)))
    # How many groups the hashes of a shard make.
    loads = probes.groupBy("shard").agg(F.ceil(F.count("*") / group_hashes).cast("long").alias("copies"))
    copies = settle(loads)
    salted = probes.join(small_side(copies), "shard").select(
        "shard", F.pmod(F.xxhash64("id", "text_hash"), F.col("copies")).alias("salt"), "id", "text_hash", "high", "low"
    )
    copied = shards.join(copies, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")

    def probe(rows: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or arrays.empty:
            return rows.iloc[:0][["id", "text_hash", "high", "low"]]
        columns = [rows[name].to_numpy(np.int64) for name in ("high", "low", "id")]
        gone = Shard.read(arrays.iloc[0]).dropped(*columns, min_documents)
        return rows.loc[gone, ["id", "text_hash", "high", "low"]]

    gone = salted.groupBy("shard", "salt").cogroup(copied.groupBy("shard", "salt")).applyInPandas(probe, f"id long, text_hash long, {HASHES}")
    # No more than the lines of one text.
    listed = gone.groupBy("id", "text_hash").agg(F.collect_set(F.struct("high", "low")).alias("gone"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch["text"]):
                lines = _lines(batch["text"].iloc[part])
                drop = []
                for document, gone in zip(lines, batch["gone"].iloc[part], strict=True):
                    pairs = {(pair["high"], pair["low"]) for pair in gone} if gone is not None else set()
                    keys = list(map(line_key, document)) if pairs else [None] * len(document)
                    drop += [key is not None and tuple(half.item() for half in hashes([key])) in pairs for key in keys]
                yield _kept(batch["id"].to_numpy(np.int64)[part], lines, np.array(drop, bool))

    return docs.join(listed, ["id", "text_hash"], "left").select("id", "text", "gone").mapInPandas(run, KEPT)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    limit: int = BROADCAST_BYTES,
    shard_hashes: int = SHARD_HASHES,
    group_hashes: int = GROUP_HASHES,
) -> DataFrame:
    """One row per document: doc_id, the text that stays, its lines before, and how many were dropped."""
    id_type = docs.schema[id_col].dataType
    docs = keyed_text(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    hashed = document_hashes(docs)
    shards, n_shards = build_shards(hashed, min_documents, shard_hashes)
    if measured_bytes(shards.drop("sizes")) <= limit:
        kept = look_up(docs, shards, n_shards, min_documents)
    else:
        kept = look_up_by_shard(docs, hashed, shards, n_shards, min_documents, group_hashes)
    return kept.select(F.when(F.col("id") != NO_ID, F.col("id")).cast(id_type).alias("doc_id"), "text", "n_lines", "n_dropped")
