"""Language identification by Bayesian fusion of evidence.

The likelihood of a text under each language comes from byte trigrams, counted
over all labelled documents. To it come, where a row has them, the likelihood of
the language its markup declares, that of the suffix of its address, and a prior
of its host. The last three are learned from all rows by grouped aggregation of
what the texts alone say; the prior of a host is smoothed towards its domain, and
that towards the whole, and leaves out the row it is asked for.

Results in special cases: null evidence counts for nothing, so a row without any
gets the language most rows have; null and empty texts likewise rest on the other
evidence; of equally likely languages the first by name is taken; documents with
a null or empty label teach nothing; without any labelled document language and
probability are null; repeated rows are told each for itself, and each counts;
empty tables give empty ones; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicksieve.llm.html_extraction import extract
from clicksieve.session import settle, small_side

BUCKETS = 1 << 15
# A text counts as this many trigrams at most: neighbours are not independent.
MOST_TRIGRAMS = 150
SMOOTHING = 0.5
# Rows that the next wider group counts as, and that the classes start with.
PRIOR_ROWS = 5.0
# The model holds BUCKETS numbers for each language.
MAX_LANGUAGES = 500

EVIDENCE = ("doc_id", "page_id", "text", "declared", "suffix", "domain", "host")


def trigrams(text: str | None) -> np.ndarray:
    """The bucket of each byte trigram of a text in lower case."""
    data = np.frombuffer(f" {text or ''} ".lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    whole = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return (whole * np.uint32(0x9E3779B1) >> np.uint32(17)).astype(np.int64)


def count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (label, text) -> (label, bucket, n) for all rows of a task."""
    counts = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
    for batch in batches:
        for label, text in zip(batch["label"], batch["text"], strict=True):
            counts[label] += np.bincount(trigrams(text), minlength=BUCKETS)
    for label, found in counts.items():
        at = np.flatnonzero(found)
        yield pd.DataFrame({"label": label, "bucket": at, "n": found[at]})


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # of each bucket in each language

    def likelihoods(self, text: str | None) -> list[float]:
        """The log-likelihood of a text in each language, the best of them 0."""
        codes = trigrams(text)
        found = self.logs[codes].sum(axis=0) * min(1.0, MOST_TRIGRAMS / max(len(codes), 1))
        return (found - found.max()).tolist()


def learn_text(docs: DataFrame, label_col: str = "lang") -> TextModel:
    labelled = docs.select(F.col(label_col).cast("string").alias("label"), "text").where(
        "label is not null and label <> '' and text is not null"
    )
    counted = labelled.mapInPandas(count_trigrams, "label string, bucket int, n long")
    found = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = settle(found)
    languages = tuple(sorted(r["label"] for r in found.select("label").distinct().limit(MAX_LANGUAGES + 1).collect()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{label_col} has more than {MAX_LANGUAGES} values; it does not look like a language")
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 0)))
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    rows = found.toPandas()  # BUCKETS rows for each language at most
    table[rows["bucket"], rows["label"].map({x: i for i, x in enumerate(languages)})] += rows["n"]
    return TextModel(languages, np.log(table / table.sum(axis=0)))


@F.pandas_udf(T.StringType())
def page_text(pages: pd.Series) -> pd.Series:
    return pages.map(extract, na_action=None)


def _or_null(text: Column) -> Column:
    return F.when(text != "", F.lower(text))


def page_evidence(pages: DataFrame) -> DataFrame:
    """What pages (page_id, url, html) say about their language."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"),
        "page_id",
        page_text("html").alias("text"),
        _or_null(declared).alias("declared"),
        _or_null(F.regexp_extract(host, r"\.([^.]+)\.?$", 1)).alias("suffix"),
        _or_null(F.regexp_extract(host, r"([^.]+\.[^.]+)\.?$", 1)).alias("domain"),
        _or_null(host).alias("host"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """What documents say: their text, and their source as a host without an address."""
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        F.lit(None).cast("long").alias("page_id"),
        "text",
        none.alias("declared"),
        none.alias("suffix"),
        none.alias("domain"),
        _or_null(F.concat(F.lit("source:"), F.col("source").cast("string"))).alias("host"),
    )


def _softmax(logs: list[Column]) -> list[Column]:
    raised = [F.exp(x - _greatest(logs)) for x in logs]
    total = sum(raised[1:], raised[0])
    return [x / total for x in raised]


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """doc_id, page_id, lang, probability and text_lang (by the text alone) of rows of EVIDENCE."""
    n = len(model.languages)
    if not n:
        none = F.lit(None).cast("string")
        return rows.select("doc_id", "page_id", none.alias("lang"), none.cast("double").alias("probability"), none.alias("text_lang"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def likelihoods(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.likelihoods(t) for t in texts], dtype=object)

    def logs(name: str) -> list[Column]:
        return [F.col(name)[i] for i in range(n)]

    groups = ("declared", "suffix", "domain", "host")
    told = rows.select("doc_id", "page_id", *groups, likelihoods("text").alias("text_logs"))
    told = settle(told.withColumn("own", F.array(*_softmax(logs("text_logs")))))

    sums = [F.sum(F.col("own")[i]).alias(f"s{i}") for i in range(n)]
    totals = told.agg(F.count("*").alias("n"), *sums).first()
    whole = [(totals[f"s{i}"] or 0.0) + PRIOR_ROWS / n for i in range(n)]
    overall = [x / sum(whole) for x in whole]

    def by(name: str) -> DataFrame:
        """Rows and languages of each group, as the texts tell them; sent to all executors where it is small."""
        table = told.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("__key")).agg(F.count("*").alias("n"), *sums)
        return small_side(settle(table.select("__key", *[F.col(c).alias(f"{name}_{c}") for c in table.columns[1:]])))

    joined = told
    for name in groups:
        # Rows without a value find no group; a key of their own spreads them over the tasks.
        own_key = F.concat(F.lit("\0"), F.xxhash64("doc_id", "page_id").cast("string"))
        joined = joined.withColumn("__key", F.coalesce(name, own_key)).join(by(name), "__key", "left").drop("__key")
        found = F.struct(F.col(f"{name}_n").alias("n"), F.array(*[f"{name}_s{i}" for i in range(n)]).alias("sums"))
        joined = joined.withColumn(f"of_{name}", F.when(F.col(f"{name}_n").isNotNull(), found))

    def likelihood(name: str, i: int) -> Column:
        """How likely rows of language i have this value, up to a factor shared by all languages."""
        group = F.col(f"of_{name}")
        own = F.col("own")[i]
        found = (group["sums"][i] - own + PRIOR_ROWS * overall[i]) / (whole[i] - own + PRIOR_ROWS)
        return F.when(group.isNull(), F.lit(0.0)).otherwise(F.log(found))

    def share(name: str, i: int, wider: Column) -> Column:
        """The share of language i in a group without this row, smoothed towards the wider one."""
        group = F.col(f"of_{name}")
        found = (group["sums"][i] - F.col("own")[i] + PRIOR_ROWS * wider) / (group["n"] - 1 + PRIOR_ROWS)
        return F.when(group.isNull(), wider).otherwise(found)

    def prior(i: int) -> Column:
        return F.log(share("host", i, share("domain", i, F.lit(overall[i]))))

    fused = F.array(
        *[F.col("text_logs")[i] + likelihood("declared", i) + likelihood("suffix", i) + prior(i) for i in range(n)]
    )
    names = F.array(*map(F.lit, model.languages))

    def best(name: str) -> Column:
        return F.get(names, F.array_position(name, F.array_max(name)).cast("int") - 1)

    return (
        joined.select("doc_id", "page_id", "own", fused.alias("fused"))
        .select("doc_id", "page_id", "own", F.array(*_softmax(logs("fused"))).alias("found"))
        .select("doc_id", "page_id", best("found").alias("lang"), F.array_max("found").alias("probability"), best("own").alias("text_lang"))
    )
