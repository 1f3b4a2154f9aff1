"""Byte-level BPE encoding and decoding with a given rank file.

Texts are split by the pattern on the JVM; each match is encoded on its own.
Ranks are a literal of the plan: an array of small maps, indexed by a hash of
the piece, so that a look-up costs the same whatever the vocabulary. A word's
bytes are folded by higher-order functions: the fold keeps the pieces and the
ranks of neighbouring pairs, and each step joins the leftmost pair of lowest
rank, until no pair has one. Pieces are held as hexadecimal digits.

Every different word would be folded once; a corpus has more of them than can be
sent anywhere, and joining words to their places would shuffle several times the
text. So the words that occur most, DICTIONARY_WORDS at most, are counted over
the whole corpus, folded once each and broadcast; the others are folded where
they stand, once for each document. Documents are not shuffled. Decoding joins
the bytes of the ids.

Results in special cases: null and empty texts have no ids and decode to no
bytes; null ids decode to null; an id that the vocabulary doesn't have decodes
to nothing; words of any length are encoded whole (the time a word takes grows
with the square of its length); repeated rows are encoded each for itself; words
that occur equally often at the edge of the dictionary stay outside together; an
empty table gives an empty one; other columns are kept, the new ones excepted.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.session import new_run_folder, settle

# Words broadcast at most, and the longest that may be among them: this is
# 80 MB at worst, if every byte were a token, and some 20 MB as a rule.
DICTIONARY_WORDS = 500_000
DICTIONARY_WORD_BYTES = 32
# Maps that the ranks are spread over.
BUCKETS = 1 << 14
NO_RANK = (1 << 31) - 1
# Words handled at a time inside a task.
SLICE_WORDS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 piece and a rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def split(text: Column, pattern: str) -> Column:
    """The matches of the pattern; white space is what Unicode says, as in the library."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


class Ranks:
    """The literals that hold a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        maps = [{} for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            name = piece.hex().upper()
            maps[xxhash.xxh64_intdigest(name.encode(), 42) & (BUCKETS - 1)][name] = rank
        self.maps = F.from_json(F.lit(json.dumps(maps)), "array<map<string, int>>")
        pieces = [None] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece.hex().upper()
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")


def _rank(maps: Column, piece: Column) -> Column:
    bucket = F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")
    return F.coalesce(F.try_element_at(F.get(maps, bucket), piece), F.lit(NO_RANK))


def _lowest(ranks: Column) -> Column:
    """The place, from 1, of the leftmost lowest rank; 0 where there is none."""
    low = F.coalesce(F.array_min(ranks), F.lit(NO_RANK))
    return F.when(low == NO_RANK, F.lit(0)).otherwise(F.array_position(ranks, low).cast("int"))


def _state(pieces: Column, ranks: Column) -> Column:
    return _bound(
        F.struct(pieces.alias("p"), ranks.alias("r")),
        lambda s: F.struct(s["p"].alias("p"), s["r"].alias("r"), _lowest(s["r"]).alias("at")),
    )


def _merge(maps: Column, s: Column) -> Column:
    """One step: join the pieces at `at` and `at + 1`."""
    pieces, ranks, at = s["p"], s["r"], s["at"]
    n = F.size(pieces)
    none = F.array().cast("array<int>")

    def step(joined: Column) -> Column:
        left = F.when(at > 1, F.array(_bound(F.concat(F.get(pieces, at - 2), joined), lambda p: _rank(maps, p)))).otherwise(none)
        right = F.when(at + 1 < n, F.array(_bound(F.concat(joined, F.get(pieces, at + 1)), lambda p: _rank(maps, p)))).otherwise(none)
        # Arrays are put together by flatten: concat of arrays is slow where no code is generated.
        return _state(
            F.flatten(F.array(F.slice(pieces, 1, at - 1), F.array(joined), F.slice(pieces, at + 2, n))),
            F.flatten(F.array(F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))), left, right, F.slice(ranks, at + 2, n))),
        )

    return _bound(F.concat(F.get(pieces, at - 1), F.get(pieces, at)), step)


def _fold(maps: Column, name: Column) -> Column:
    """The ids of a word given as hexadecimal digits."""

    def merged(pieces: Column) -> Column:
        n = F.size(pieces)
        pairs = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
        first = F.transform(pairs, lambda i: _rank(maps, F.concat(F.get(pieces, i - 1), F.get(pieces, i))))
        return F.aggregate(
            pairs,
            _state(pieces, first),
            lambda s, _: F.when(s["at"] == 0, s).otherwise(_merge(maps, s)),
            lambda s: F.transform(s["p"], lambda piece: _rank(maps, piece)),
        )

    whole = _rank(maps, name)
    return F.when(whole != NO_RANK, F.array(whole)).otherwise(
        _bound(F.regexp_extract_all(name, F.lit(".."), F.lit(0)), merged)
    )


def fold(ranks: Ranks, word: Column) -> Column:
    """The ids of one word."""
    return _bound(ranks.maps, lambda maps: _fold(maps, F.hex(F.encode(word, "UTF-8"))))


def dictionary(words: DataFrame, ranks: Ranks, most: int = DICTIONARY_WORDS) -> pa.Table:
    """word, ids of the words that occur most; at most `most`, and none that occur but once."""
    spark = words.sparkSession
    folder = new_run_folder(spark, "words")
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    counted.where((F.col("n") > 1) & (F.octet_length("word") <= DICTIONARY_WORD_BYTES)).write.parquet(folder)
    counted = spark.read.schema("word string, n long").parquet(folder)
    capped = F.least("n", F.lit(100_000)).alias("n")
    found = sorted(counted.groupBy(capped).agg(F.count("*").alias("words")).collect(), reverse=True)
    least, n_words = 100_001, 0
    for n, of_this in found:
        if n_words + of_this > most:
            break
        least, n_words = n, n_words + of_this
    # Settled first: a plan without an exchange is described once, and the description spells out the literals.
    chosen = settle(counted.where(F.col("n") >= least).select("word").repartition(4 * spark.sparkContext.defaultParallelism, "word"))
    return chosen.select("word", fold(ranks, F.col("word")).alias("ids")).toArrow()


class Coder:
    """Gives the words of the dictionary their ids, and lists the others."""

    def __init__(self, table: pa.Table):
        self.words = table["word"].combine_chunks().cast(pa.string())
        lists = table["ids"].combine_chunks()
        offsets = lists.offsets.to_numpy()
        self.starts, self.sizes = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
        self.ids = np.append(lists.values.to_numpy(zero_copy_only=False), 0).astype(np.int32)

    def code(self, lists: pa.ListArray) -> pa.StructArray:
        words = lists.flatten()
        index = pc.index_in(words, value_set=self.words)  # hashes the dictionary, so once for all
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        parts, at = [], 0
        while at < len(lists):
            # Whole documents, of about SLICE_WORDS words together.
            to = max(at + 1, int(np.searchsorted(offsets[1:], offsets[at] + SLICE_WORDS, "right")))
            low, n = int(offsets[at]), int(offsets[to] - offsets[at])
            parts.append(self._code(np.diff(offsets[at : to + 1]), words.slice(low, n), index.slice(low, n)))
            at = to
        return pa.concat_arrays(parts) if parts else self._code(np.empty(0, np.int64), words, index)

    def _code(self, per_doc: np.ndarray, words: pa.Array, index: pa.Array) -> pa.StructArray:
        unknown = index.is_null().to_numpy(zero_copy_only=False)
        index = index.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.starts):
            sizes, starts = np.where(unknown, 1, self.sizes[index]), np.where(unknown, len(self.ids) - 1, self.starts[index])
        else:
            sizes, starts = np.ones(len(words), np.int64), np.zeros(len(words), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = self.ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        # The unknown words of each document, each once, in the order of their codes.
        docs = np.repeat(np.arange(len(per_doc)), per_doc)[unknown]
        rare = words.filter(pa.array(unknown)).dictionary_encode()
        codes = np.asarray(rare.indices).astype(np.int64)
        n_codes = max(len(rare.dictionary), 1)
        pairs, inverse = np.unique(docs * n_codes + codes, return_inverse=True)
        doc_starts = np.searchsorted(pairs, np.arange(len(per_doc) + 1) * n_codes)
        at = ends[:-1][unknown]
        out[at] = -1 - (inverse - doc_starts[docs])
        # Runs of ids end before and after such a word, and with the document.
        doc_ends = ends[np.concatenate([[0], np.cumsum(per_doc)])]
        cuts = np.unique(np.concatenate([doc_ends, at, at + 1]))
        runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(out, pa.int32()))
        doc_runs = np.searchsorted(cuts, doc_ends)
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(doc_runs, pa.int32()), runs),
                pa.ListArray.from_arrays(pa.array(doc_starts, pa.int32()), rare.dictionary.take(pa.array(pairs % n_codes))),
            ],
            names=["runs", "rare"],
        )


def encode(docs: DataFrame, ranks: Ranks, pattern: str, text_col: str = "text", most: int = DICTIONARY_WORDS) -> DataFrame:
    """The documents with a column `ids`."""
    words = docs.select(F.explode(split(F.col(text_col), pattern)).alias("word"))
    shared = docs.sparkSession.sparkContext.broadcast(Coder(dictionary(words, ranks, most)))

    @F.arrow_udf("struct<runs: array<array<int>>, rare: array<string>>")
    def coded(lists: pa.Array) -> pa.Array:
        return shared.value.code(lists)

    def filled(maps: Column) -> Column:
        rare = F.transform("__coded.rare", lambda word: _fold(maps, F.hex(F.encode(word, "UTF-8"))))
        # A run that begins with -1, -2, ... stands for the first, second, ... of the rare words.
        return _bound(
            rare,
            lambda found: F.flatten(
                F.transform(
                    "__coded.runs",
                    lambda run: F.when(F.get(run, 0) >= 0, run).otherwise(F.get(found, -1 - F.get(run, 0))),
                )
            ),
        )

    ids = F.when(F.size("__coded.rare") == 0, F.flatten("__coded.runs")).otherwise(_bound(ranks.maps, filled))
    return docs.withColumn("__coded", coded(split(F.col(text_col), pattern))).withColumn("ids", ids).drop("__coded")


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes of a column of ids."""
    joined = _bound(
        ranks.pieces, lambda pieces: F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")
    )
    return F.when(ids.isNotNull(), F.unhex(joined))
