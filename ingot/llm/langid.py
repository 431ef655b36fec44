"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent letter n-grams (one to
three letters, words padded by a blank).  A document's own ranking is compared
with each profile by out-of-place distance: how far each n-gram stands from its
place in the profile, and the profile's length where it is missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS, small_batches, text_batches

UNDETERMINED = "und"
SHARPNESS = 40.0                   # turns distances (0 to 1) into a confidence


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, or 0.  Letters lie below 2**18."""
    out = np.zeros(0x110000, np.uint64)
    for cp in range(0x40000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _gram_codes(text: str, tail: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end in a slice of a text; ``tail`` are the (up to two) letters
    and blanks before it.  Returns the codes, unsorted, and the tail of the next slice."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = _letters()[points]
    s = np.concatenate([tail, s, np.zeros(int(last), np.uint64)])
    new = len(tail)
    keep = np.ones(len(s), bool)                     # one blank between words
    keep[new:] = (s[new:] != 0) | (s[new - 1:-1] != 0)
    s = s[keep]
    n = np.uint64
    one = s[new:][s[new:] != 0]
    two = (s[new - 1:-1] << n(18)) | s[new:]
    two = two[two != 0]
    first = max(new, 2)
    mid = s[first - 1:-1] != 0
    three = ((s[first - 2:-2] << n(36)) | (s[first - 1:-1] << n(18)) | s[first:])[mid]
    return np.concatenate([one | n(1 << 60), two | n(2 << 60), three | n(3 << 60)]), s[-2:]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes.sort()
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))[:len(codes)]
    return codes[at], np.diff(np.append(at, len(codes)))


def gram_counts(text: str, size: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of all 1- to 3-grams of a whole text; empty without letters.

    Texts longer than ``size`` characters are counted slice by slice, so the memory
    beyond the text follows the slice and the number of distinct n-grams."""
    tail = np.zeros(1, np.uint64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, len(text), size) or (0,):
        codes, tail = _gram_codes(text[lo:lo + size], tail, lo + size >= len(text))
        parts.append(_counted(codes))
        if len(parts) > 1:
            parts = [_merged(parts)]
    return parts[0]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    whole, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    n = np.bincount(at, np.concatenate([n for _, n in parts]), len(whole))
    return whole, n.astype(np.int64)


def ranking(text: str, size: int) -> np.ndarray:
    """Codes of the ``size`` most frequent n-grams, best first; ties by code."""
    codes, counts = gram_counts(text)
    if len(codes) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= floor
        codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))][:size]


def train_profiles(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang",
                   doc_id: str = "doc_id", size: int = 300,
                   sample_rows: int = 2000, max_languages: int = 2000) -> dict[str, np.ndarray]:
    """Profiles (codes, best first) of every language in ``lang`` among rows where ``train``.

    Fitted on a bounded sample: about ``sample_rows`` rows of each language, chosen
    by a hash of document id and text (equal rows come all or none).  Rows with a null
    language or text teach nothing.  Without any there is no profile; more than
    ``max_languages`` values are an error, since each gets a profile on the driver.
    """
    spark = docs.sparkSession
    own = docs.where(train & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 30)).alias("h"))
    sizes = own.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"{lang!r} has more than {max_languages} values")
    limits = spark.createDataFrame(
        [(r["lang"], min(1 << 30, -(-(sample_rows << 30) // r["count"]))) for r in sizes],
        "lang string, below long")                           # at most max_languages rows
    own = own.join(F.broadcast(limits), "lang").where("h < below")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, part in f.groupby("lang"):
                whole, n = np.empty(0, np.uint64), np.empty(0, np.int64)
                for lo in range(0, len(part), ROWS):
                    whole, n = _merged([(whole, n), *map(gram_counts, part["text"][lo:lo + ROWS])])
                yield pd.DataFrame({"lang": name, "code": whole.view(np.int64), "n": n})
    counts = own.where(F.col("text").isNotNull()).select("lang", "text").mapInPandas(
        run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = counts.withColumn("r", F.row_number().over(top)).where(F.col("r") <= size).select(
        "lang", "code", "r").collect()                       # languages x size rows
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.r)):
        out.setdefault(r.lang, []).append(r.code)
    return {k: np.array(v, np.int64).view(np.uint64) for k, v in out.items()}


class Matcher:
    """Compares rankings with all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = 300):
        self.names, self.size = sorted(profiles), size
        self.codes = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.uint64)]))
        self.place = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)
        for j, name in enumerate(self.names):
            at = np.searchsorted(self.codes, profiles[name])
            self.place[at, j] = np.arange(len(at))

    def distances(self, text: str) -> np.ndarray | None:
        """Out-of-place distance to each profile, 0 to 1; None without letters."""
        own = ranking(text, self.size)
        if not len(own) or not self.names:
            return None
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        known = self.codes[at] == own
        place = self.place[np.where(known, at, len(self.codes))]
        off = np.abs(place - np.arange(len(own))[:, None])
        return np.where(place < 0, self.size, off).sum(0) / (self.size * len(own))

    def predict(self, text: str) -> tuple[str, float]:
        d = self.distances(text)
        if d is None:
            return UNDETERMINED, 0.0
        best = int(d.argmin())                               # ties: the first name
        return self.names[best], float(1 / np.exp(-SHARPNESS * (d - d[best])).sum())


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], doc_id: str = "doc_id",
             text: str = "text", size: int = 300) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    ``und`` with score 0 if the text is null or has no letter, or if there is no
    profile.  The score is the share of the best language in a softmax over the
    distances; of languages at equal distance the first by name is named.  Repeated
    rows each get their row; an empty table gives no rows; other columns are ignored.
    Texts of any length are counted whole, in slices.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(profiles, size)
        for keys, texts in text_batches(batches):
            found = [matcher.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])
    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def accept(docs: DataFrame, profiles: dict[str, np.ndarray], min_score: float = 0.5,
           text: str = "text", size: int = 300) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with ``min_score`` or more.

    Texts that are null or have no letter go; repeated rows and null ids are judged each
    by its text.  Rows without any profile to judge them by are an error."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(profiles, size)
        for batch in small_batches(batches):
            if not profiles:
                raise ValueError("no language profile: no row has a language to learn from")
            found = [matcher.predict(t or "") for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([name != UNDETERMINED and s >= min_score
                                         for name, s in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
