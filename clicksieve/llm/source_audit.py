"""Source divergence audit by count-cell ranking.

Which sources of a language write differently, and by which terms. Every source
and the language as a whole give each kept term a smoothed share p, in parts of
10^9; terms, and pairs of sources, are ranked by f = (p - q)^2 / (p + q).

f depends on counts alone. So terms are grouped by (count in the source, count
in the language); f is worked out once for each of these cells; cells of equal f
are merged and ranked by how many terms stand before them; only the terms of
cells that reach the wanted ranks are fetched, and put in order by their bytes.
For pairs of sources, tasks take blocks of terms and of sources and sum f over the
terms that any source of the block has; terms that none has are one more cell,
counted but never listed. All numbers are whole.

Documents are cut into terms and counted task by task before anything is
shuffled; no task holds more than one block.

Results in special cases: null or empty text has no terms, null language and
source are ''; a group without terms gives each kept term the smoothed share, and
a language without kept terms has pairs of value 0; a source that is alone has no
pairs. Each row is a document, repeated ones and those with equal ids or none too;
an empty table gives an empty one; other columns are not looked at. Counts are
longs; V and N are bounded by what a long holds.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.session import settle, small_side

# Python workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
# Terms and sources of a block.
BLOCK_TERMS = 4096
BLOCK_SOURCES = 128
# Different terms a task counts before it hands them on, and characters it cuts up at once.
COUNTED_TERMS = 500_000
TOGETHER = 1 << 22

SUMS = "lang string, side_1 int, side_2 int, at_1 int, at_2 int, value long, terms long"
COUNTS = "lang string, source string, term string, n long, n_docs long"

# Bytes that terms are made of stay, A-Z in lower case; others become spaces.
_FOLDED = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split()


def audited(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    columns = {"lang": lang_col, "source": source_col, "text": text_col}
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in columns.items()])


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, text -> how often, and in how many documents, each (lang, source) has a term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def counted() -> Iterator[pd.DataFrame]:
            for (lang, source), (n, n_docs) in found.items():
                if n:
                    names = [term.decode("utf-8", "surrogatepass") for term in n]
                    numbers = {"n": list(n.values()), "n_docs": [n_docs[term] for term in n]}
                    yield pd.DataFrame({"lang": [lang] * len(n), "source": [source] * len(n), "term": names} | numbers)
            found.clear()

        for batch in batches:
            for (lang, source), group in batch.groupby(["lang", "source"], sort=False):
                n, n_docs = found[lang, source]
                part, size = [], 0
                for text in group["text"]:
                    part.append(terms(text))
                    size += len(text)
                    if size > TOGETHER:
                        n.update(chain.from_iterable(part))
                        n_docs.update(chain.from_iterable(map(set, part)))
                        part, size = [], 0
                n.update(chain.from_iterable(part))
                n_docs.update(chain.from_iterable(map(set, part)))
                if sum(len(n) for n, _ in found.values()) > COUNTED_TERMS:
                    yield from counted()
        yield from counted()

    partial = docs.mapInPandas(run, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), with products of 38 digits."""
    product = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    parts = (total + 2 * kept).cast("decimal(19,0)")
    return 1 + F.call_function("div", product, parts)


def _divergence(p: Column, q: Column) -> Column:
    # p and q are at most 10^9 + 1, so the square is a long.
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """The counts of a corpus, and what is ranked by them."""

    def __init__(self, docs: DataFrame, min_documents: int = MIN_DOCUMENTS):
        """`docs` has lang, source and text, none of them null."""
        counts = settle(count_terms(docs))
        whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
        kept = whole.where(F.col("n_docs") >= min_documents).drop("n_docs")
        # Kept terms of each group, with both counts.
        self.kept = settle(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
        languages = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("lang_n").alias("lang_total"))
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
        zero = F.lit(0).cast("long")
        # One row for each (lang, source): terms kept by the language, and occurrences of them there and in all.
        self.groups = settle(
            groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n_kept", "lang_total", "total")])
        )

    def ranked_terms(self, top: int = TOP_TERMS) -> DataFrame:
        """lang, source, item, value, rank: the terms each source uses more than its language, `top` of them at most."""
        sizes = small_side(self.groups.where("n_kept > 0"))
        p = _share(F.col("n"), F.col("total"), F.col("n_kept"))
        q = _share(F.col("lang_n"), F.col("lang_total"), F.col("n_kept"))
        cells = (
            self.kept.groupBy("lang", "source", "n", "lang_n")
            .agg(F.count("*").alias("terms"))
            .join(sizes, ["lang", "source"])
            .select("lang", "source", "n", "lang_n", "terms", p.alias("p"), q.alias("q"))
            .where("p > q")
            .select("lang", "source", "n", "lang_n", "terms", _divergence(F.col("p"), F.col("q")).alias("value"))
        )
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        # Every value has a term at least, so `top` values are enough.
        merged = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
        best = merged.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= top)
        before = F.sum("terms").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
        reached = best.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
        # At most `top` values of a group, so of its cells only those that have one of them.
        wanted = settle(
            cells.join(small_side(settle(reached.select("lang", "source", "value"))), ["lang", "source", "value"])
            .select("lang", "source", "n", "lang_n", "value")
        )
        in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (
            self.kept.join(small_side(wanted), ["lang", "source", "n", "lang_n"])
            .select("lang", "source", F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(in_order))
            .where(F.col("rank") <= top)
        )

    def ranked_pairs(self, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
        """lang, source, item, value, rank: all other sources of the language, the most different first."""
        numbered = Window.partitionBy("lang").orderBy("source")
        place = F.row_number().over(numbered) - 1
        # `least` is the share of a term that the source does not have.
        sources = settle(
            self.groups.select(
                "lang", "source", "total", "n_kept",
                F.floor(place / block_sources).cast("int").alias("side"), (place % block_sources).alias("at"),
                F.when(F.col("n_kept") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("n_kept"))).alias("least"),
            )
        )
        sums = self._block_sums(sources, block_terms)
        one, other = (
            sources.select("lang", F.col("source").alias(name), *[F.col(c).alias(f"{c}_{i}") for c in ("side", "at", "least")], *more)
            for i, name, more in ((1, "source", ["n_kept"]), (2, "item", []))
        )
        # Terms that no source of the two sides has, and sides that have none at all.
        unseen = F.col("n_kept") - F.coalesce("terms", F.lit(0))
        value = F.coalesce("value", F.lit(0)) + unseen * F.coalesce(_divergence(F.col("least_1"), F.col("least_2")), F.lit(0))
        in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (
            one.join(other, "lang")
            .where("source != item")
            .join(sums, ["lang", "side_1", "side_2", "at_1", "at_2"], "left")
            .select("lang", "source", "item", value.cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(in_order))
        )

    def _block_sums(self, sources: DataFrame, block_terms: int) -> DataFrame:
        """For places in two sides: the sum of f over the terms that any source of these has, and their number."""
        of_source = sources.where("n_kept > 0")
        # Terms are dealt into blocks by their hash.
        blocks = F.ceil(F.col("n_kept") / block_terms).cast("long")
        shares = self.kept.join(small_side(of_source), ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "side", "at", "term",
            _share(F.col("n"), F.col("total"), F.col("n_kept")).alias("p"),
        )
        by_side = of_source.groupBy("lang", "side").agg(
            F.max("n_kept").alias("n_kept"), F.transform(F.sort_array(F.collect_list(F.struct("at", "least"))), lambda s: s["least"]).alias("least")
        )
        by_side = settle(by_side)
        sides = by_side.select("lang", F.col("side").alias("other"))
        # A side's terms meet those of every side, itself included; the smaller number goes first.
        dealt = shares.join(small_side(sides), "lang").select(
            "lang", "block", F.least("side", "other").alias("side_1"), F.greatest("side", "other").alias("side_2"), "side", "at", "term", "p"
        )
        first, second = (
            by_side.select("lang", F.col("side").alias(f"side_{i}"), F.col("least").alias(f"least_{i}"), *more) for i, more in ((1, ["n_kept"]), (2, []))
        )
        tasks = (
            first.join(second, "lang").where("side_1 <= side_2").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        )
        key = ["lang", "block", "side_1", "side_2"]
        partial = dealt.groupBy(*key).cogroup(tasks.groupBy(*key)).applyInPandas(sum_block, SUMS)
        return partial.groupBy("lang", "side_1", "side_2", "at_1", "at_2").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def sum_block(rows: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
    """Sums of f for every source of one side and every source of the other, over the terms of one block."""
    if rows.empty:
        return pd.DataFrame(columns=["lang", "side_1", "side_2", "at_1", "at_2", "value", "terms"])
    task = sides.iloc[0]
    column, found = pd.factorize(rows["term"])
    shares = []
    for i in (1, 2):
        least = np.asarray(task[f"least_{i}"], np.int64)
        own = (rows["side"] == task[f"side_{i}"]).to_numpy()
        matrix = np.repeat(least[:, None], len(found), axis=1)
        matrix[rows["at"].to_numpy()[own], column[own]] = rows["p"].to_numpy(np.int64)[own]
        shares.append(matrix)
    first, second = shares
    sums = np.empty((len(first), len(second)), np.int64)
    for i, p in enumerate(first):
        away = second - p
        sums[i] = (away * away // (second + p)).sum(axis=1)
    at_1, at_2 = (a.ravel() for a in np.indices(sums.shape))
    size = {"value": sums.ravel(), "terms": len(found)}
    parts = [{"side_1": task["side_1"], "side_2": task["side_2"], "at_1": at_1, "at_2": at_2} | size]
    if task["side_1"] != task["side_2"]:
        # Each pair of sides is met once and counts for both directions.
        parts.append({"side_1": task["side_2"], "side_2": task["side_1"], "at_1": at_2, "at_2": at_1} | size)
    return pd.concat(map(pd.DataFrame, parts)).assign(lang=task["lang"])


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, **blocks: int) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank."""
    counted = Audit(audited(docs), min_documents)
    parts = [counted.ranked_pairs(**blocks).withColumn("part", F.lit("pair")), counted.ranked_terms(top).withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
