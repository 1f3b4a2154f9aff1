"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are linked when at most three bits differ. Then at most
one bit differs in one of their halves. For each half the anchors are the words
of a covering code: the (31, 26) Hamming code on 31 bits with one free bit
beside it, whose covering radius is 1, so that every half-fingerprint has an
anchor at distance 1 at most. A fingerprint is replicated to every anchor within
covering radius plus threshold, here 1 + 1 bits; the anchor nearest to one of
two linked fingerprints is then among the anchors of the other, and comparing
whole fingerprints anchor by anchor finds every link.

Only different fingerprints are replicated, so copies of a text cost nothing
here. What leaves a comparison is a spanning forest of the links found in it,
never all pairs; anchors that very many fingerprints share are compared in
pairs of slices, each a group of its own. Components come from rounds in which
every fingerprint joins the smallest one near it.

Results in special cases: a null, empty or white text has the fingerprint zero
and links like any other; texts with fewer words than a shingle have one
shingle, all of their words; of equal ids or repeated rows each row is returned,
with the same component; a component whose ids are all null has the component
null; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.llm.common import keyed_text
from clicksieve.session import settle

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# Fingerprints that one comparison holds at most (two slices of an anchor's).
SLICE = 2048

_POSITIONS = np.arange(1, 32, dtype=np.uint32)
_ONE = np.uint32(1)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - shingle_words + 1, 1)
    last = ends[-n:].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # blocks bound the memory of the unpacked bits
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint3(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint, na_action=None).astype("int64")


def _syndromes(halves: np.ndarray) -> np.ndarray:
    """The position (1 to 31) of the bit that leads to the nearest code word; 0 for a code word."""
    out = np.zeros(len(halves), np.uint32)
    for position in _POSITIONS:
        out ^= position * ((halves >> (position - _ONE)) & _ONE)
    return out


def anchors(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within two bits of each half: (index of the half, anchor)."""
    bit31 = np.uint32(1 << 31)
    flip = np.concatenate([np.zeros(1, np.uint32), _ONE << (_POSITIONS - _ONE)])
    syndromes = _syndromes(halves)
    nearest = halves ^ flip[syndromes]
    rows = np.arange(len(halves))
    found = [(rows, nearest), (rows, nearest ^ bit31)]
    # Code words two bits away: flip positions p < q with p xor q equal to the syndrome.
    for p in _POSITIONS:
        q = syndromes ^ p
        at = np.flatnonzero((q > p) & (syndromes > 0))
        found.append((at, halves[at] ^ flip[p] ^ flip[q[at]]))
    # With the free bit flipped one more flip is left, which `nearest` spends.
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """fingerprint -> a row for each anchor near one of its halves."""
    for batch in batches:
        whole = batch["node"].to_numpy(np.int64)
        bits = whole.view(np.uint64)
        for half, halves in enumerate(((bits >> np.uint64(32)).astype(np.uint32), bits.astype(np.uint32))):
            rows, anchor = anchors(halves)
            yield pd.DataFrame({"anchor": anchor.astype(np.int64) * 2 + half, "node": whole[rows]})


def _links(nodes: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one group."""
    bits, labels, out = nodes.view(np.uint64), np.arange(len(nodes)), []
    for i in range(len(nodes) - 1):
        near = np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= max_distance
        near &= labels[i + 1 :] != labels[i]
        for j in (i + 1 + np.flatnonzero(near)).tolist():
            if labels[j] != labels[i]:
                labels[labels == labels[j]] = labels[i]
                a, b = int(nodes[i]), int(nodes[j])
                out.append((min(a, b), max(a, b)))
    return out


def _neighbours(keys: list[np.ndarray], nodes: np.ndarray, longest: int, max_distance: int) -> list[tuple[int, int]]:
    """Links among rows of equal keys, by comparing every row with those up to `longest` after it."""
    bits, out = nodes.view(np.uint64), []
    for lag in range(1, longest):
        near = np.bitwise_count(bits[lag:] ^ bits[:-lag]) <= max_distance
        for key in keys:
            near &= key[lag:] == key[:-lag]
        for i in np.flatnonzero(near):
            a, b = int(nodes[i]), int(nodes[i + lag])
            out.append((min(a, b), max(a, b)))
    return out


def compare(max_distance: int):
    """Rows (anchor, part, node) sorted by group -> links (a, b), a spanning forest of each large group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # a group may go on in the next batch
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rows[["anchor", "part"]].iloc[-1]
            goes_on = (rows["anchor"] == last["anchor"]) & (rows["part"] == last["part"])
            rest = rows[goes_on]
            yield links(rows[~goes_on])
        if rest is not None:
            yield links(rest)

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        anchor, part, nodes = (rows[c].to_numpy(np.int64) for c in ("anchor", "part", "node"))
        if not len(nodes):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
        sizes = np.diff(np.r_[starts, len(nodes)])
        is_small = np.repeat(sizes <= 16, sizes)
        found = _neighbours([anchor[is_small], part[is_small]], nodes[is_small], 16, max_distance)
        for start, size in zip(starts[sizes > 16], sizes[sizes > 16], strict=True):
            found += _links(nodes[start : start + size], max_distance)
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")

    return run


def link(nodes: DataFrame, max_distance: int = MAX_DISTANCE, slice_rows: int = SLICE // 2) -> DataFrame:
    """Links (a, b) that connect all fingerprints `node` at most `max_distance` bits apart, a < b.

    Spanning forests of what meets at each anchor: every link is there or is
    implied by others.
    """
    if max_distance > 3:
        raise ValueError("the anchors cover distances of up to three bits")
    # Dealt out once: the counts and the join below need no exchange of their own.
    met = nodes.mapInPandas(replicate, "anchor long, node long").repartition("anchor")
    slices = F.ceil(F.col("n") / slice_rows)
    sized = met.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", slices.alias("slices"))
    own = F.pmod(F.xxhash64("node"), F.col("slices"))
    # Slices i <= j form the group (i, j); with one slice that is the anchor itself.
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("slices") - 1),
        lambda other: F.least(own, other) * F.col("slices") + F.greatest(own, other),
    )
    groups = (
        met.join(sized, "anchor")
        .select("anchor", F.explode(others).alias("part"), "node")
        .repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part")
    )
    return groups.mapInPandas(compare(max_distance), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links (a, b) connect it with.

    Every round sends each node's larger neighbours to the smallest one near
    it, then its smaller ones, until nothing changes.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = settle(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _clustered(docs: DataFrame, max_distance: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, node of every row; and node, root, component_id of every fingerprint."""
    marked = settle(docs.select("doc_id", fingerprint3("text").alias("node")))
    nodes = marked.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    roots = components(link(nodes.select("node"), max_distance))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked, rooted.join(firsts, "root").select("node", "root", "component_id")


def cluster(
    docs: DataFrame, max_distance: int = MAX_DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (its smallest doc_id)."""
    marked, named = _clustered(keyed_text(docs, id_col, text_col), max_distance)
    return marked.join(named, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns.

    Of rows of a component that share this doc_id one is kept, whatever other
    components have. Where no row of a component has a doc_id, one of its rows is
    kept.
    """
    columns = docs.columns
    marked, named = _clustered(docs.select("doc_id", "text"), max_distance)
    # A doc_id may stand for different texts, so the fingerprint tells which component a row is of.
    firsts = (
        marked.join(named.where("component_id is not null"), "node")
        .where("doc_id = component_id")
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "node")).alias("first"))
        .select("first.doc_id", F.col("first.node").alias("__node"))
    )
    with_id = docs.withColumn("__node", fingerprint3("text")).join(firsts, ["doc_id", "__node"], "left_semi").dropDuplicates(["doc_id", "__node"])
    nameless = named.where("component_id is null").select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    without_id = (
        docs.where(F.col("doc_id").isNull())
        .withColumn("__node", fingerprint3("text"))
        .join(nameless, "__node")
        .dropDuplicates(["__root"])
    )
    return with_id.select(columns).unionByName(without_id.select(columns))
