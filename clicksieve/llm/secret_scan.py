"""Secret scan: base patterns, and novelty against primed zstandard dictionaries.

The base patterns find assignments, access keys and long hexadecimal strings.
Beyond them, a candidate is a long run of key characters that something sensitive
is named in or around, on either side and across lines; other runs of key
characters in between count as no distance. Its novelty is what it adds to the
compressed size when zstandard already knows the code around it and a dictionary
of identifiers: names and prose repeat what is known and shrink, keys do not.
Other copies of a candidate are no code around it and make nothing known.
Candidates that add what random characters of their alphabet would, are reported.

Results in special cases: null and empty texts have no spans; spans count code
points; a candidate inside a base span is not reported again; spans of different
kinds may overlap, ties are ordered by kind; repeated rows are scanned each for
itself; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds in order, and the base patterns with the lengths they ask for.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_VALUE = 6
# Runs of these two are matched whole, so asking for their length at once finds the same.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
SENSITIVE = re.compile(
    # Neither authors and authorities nor what is salty or secretarial.
    r"password|passwd|passphrase|pwd|secret(?!ar)|token|api[_-]?key|access[_-]?key|private|credential|auth(?!or(?!i)|orit)|bearer|signature|"
    r"(?<![a-z])salt(?![a-z])",
    re.IGNORECASE | re.ASCII,
)
# Characters on either side that prime the dictionary; something sensitive must be named in as many outside of candidates.
SURROUNDING = 512
# The least share that a candidate must add of what random characters of its alphabet would.
NOVELTY = 0.75
# Random characters beyond so many add in proportion.
DRAWN = 4096
# Runs of characters that share as many in a row are copies of each other.
COPIED = 16
# Names that code is made of, known before any text is read.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key client_id client_secret "
    "username user_name database connection string config settings environment variable default example "
    "authorization bearer authentication credential credentials certificate signature encryption decryption "
    "function return class import from include require export const static void public private protected "
    "request response session cookie header content application json server localhost http https "
    "getElementById querySelector addEventListener toString valueOf charAt substring indexOf length "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
)

Span = tuple[int, int, int]  # start, kind, end
SPANS = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType()))


def _alphabet(candidate: str) -> str:
    """The characters that a candidate looks drawn from: whole classes of letters and digits, and its own signs."""
    own = set(candidate)
    signs = "".join(sorted(c for c in own if not c.isalnum()))
    letters_and_digits = own - set(signs)
    for known in ("0123456789", "0123456789abcdef", "0123456789ABCDEF"):
        if letters_and_digits and letters_and_digits <= set(known):
            return known + signs
    classes = [c for c in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if own & set(c)]
    # A ruler of signs alone is held against all characters.
    return "".join(classes or [string.digits, string.ascii_letters]) + signs


def _added(candidate: str, known: str) -> int:
    """The bytes that a candidate adds when `known` and the identifiers are known."""
    primed = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + known).encode("utf-8", "surrogatepass"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_dict_id=False)
    return len(packer.compress(candidate.encode())) - len(packer.compress(b""))


@lru_cache(maxsize=10_000)
def _random_adds(length: int, alphabet: str) -> float:
    """The bytes that random characters add: their entropy once zstandard codes them, their number while they are few."""
    n = min(length, DRAWN)
    return _added("".join(random.Random(n).choices(alphabet, k=n)), "") * length / n


def _novelty(candidate: str, around: str) -> float:
    """The marginal compressed bytes of a candidate, as a share of those of random characters of its alphabet."""
    return _added(candidate, around) / _random_adds(len(candidate), _alphabet(candidate))


def _around(text: str, runs: list[tuple[int, int]], index: int) -> str:
    """The text on both sides of a run, without the runs that are copies of it or of a part."""
    start, end = runs[index]
    low, high = max(0, start - SURROUNDING), min(len(text), end + SURROUNDING)
    first, last = index, index
    while first and runs[first - 1][1] > low:
        first -= 1
    while last + 1 < len(runs) and runs[last + 1][0] < high:
        last += 1
    parts, at = [], low
    for s, e in runs[first : last + 1]:
        # No more of a run than can be seen, and what decides on that.
        near = range(max(s, low - COPIED), min(e, high + COPIED) - COPIED + 1)
        if s == start or any(text.find(text[i : i + COPIED], start, end) >= 0 for i in near):
            parts.append(text[at : max(s, low)])
            at = min(e, high)
    return "".join([*parts, text[at:high]])


def _in_context(text: str, runs: list[tuple[int, int]]) -> list[int]:
    """The runs that something sensitive is named in or around."""
    named = [m.span() for m in SENSITIVE.finditer(text)] if runs else []
    if not named:
        return []
    # Distances leave out the characters of runs: a long key is not far from its other end.
    starts = [s for s, _ in runs]
    inside = [0, *accumulate(e - s for s, e in runs)]  # characters of the runs before each

    def place(at: int) -> int:
        k = bisect_right(starts, at)
        return at - inside[k] + max(0, runs[k - 1][1] - at if k else 0)

    begins, ends = [place(s) for s, _ in named], [place(e) for _, e in named]
    found = []
    for k, (start, _) in enumerate(runs):
        here = start - inside[k]
        at = bisect_left(begins, here - SURROUNDING)
        if at < len(named) and ends[at] <= here + SURROUNDING:
            found.append(k)
    return found


def scan(text: str | None) -> list[Span]:
    """All spans of a text, in order."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    for k in _in_context(text, runs):
        start, end = runs[k]
        if any(s <= start and end <= e for s, _, e in base):
            continue
        if _novelty(text[start:end], _around(text, runs, k)) >= NOVELTY:
            found.append((start, 3, end))
    return sorted(found)


@F.pandas_udf(SPANS)
def spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[(KINDS[kind], start, end) for start, kind, end in scan(text)] for text in texts], dtype=object)


@F.pandas_udf(T.StringType())
def masked(texts: pd.Series) -> pd.Series:
    """Texts with every span replaced by the name of its kind; null stays null."""
    return texts.map(mask, na_action=None)


def mask(text: str | None) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for start, kind, end in scan(text):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def written(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans, by start, then kind."""
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col)).alias("spans"))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The documents with their secrets masked, and n_chars, if there, counted anew; texts without any stay as they are."""
    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
