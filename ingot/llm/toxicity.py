"""Toxicity by a convolutional text classifier, trained in numpy, shard by shard on the executors.

Words are hashed to embeddings (the word, and its first letters), filters of
several widths slide over the whole text, each filter's highest answer is kept
(max pooling), and a logistic layer scores them.  Thresholds are calibrated for
each language, as told from the text by rank-order profiles; a document's score
is scaled so that its language's threshold stands at 0.7.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROWS, text_batches
from .langid import Matcher, train_profiles

WORDS, HEADS, DIM, WIDTHS, FILTERS = 1 << 15, 1 << 13, 16, (1, 2, 3), 12
HEAD = 5                           # first letters of a word that have an embedding too
BINS = 100                         # score bins to a unit of log odds, for the thresholds
CHUNK = 1 << 13                    # weights that are averaged together
CUT = 0.7                          # where a calibrated threshold stands
PAD = WORDS - 1                    # the word between documents; its embedding stays zero
_WORD = re.compile(r"[^\W\d_]+")


class WordHash:
    """Words of a text as (word, head) bucket numbers, remembered per worker up to a bound."""

    def __init__(self, most: int = 500_000):
        self.most, self.known = most, {}

    def __call__(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > self.most:
                self.known = {}
            for w in set(words):
                if w not in self.known:
                    raw = w.encode()
                    self.known[w] = zlib.crc32(raw) % PAD * HEADS + zlib.crc32(
                        w[:HEAD].encode()) % HEADS
            found = list(map(self.known.get, words))
        return np.array(found, np.int64)


@dataclass
class Model:
    """Weights, language profiles and the threshold of each language (on the raw score)."""

    word: np.ndarray
    head: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    profiles: dict[str, np.ndarray] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def bucket_counts(docs: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many toxic documents, and how many of all, hold each word bucket and, behind those,
    each head bucket."""
    with_toxic, with_any = np.zeros(WORDS + HEADS), np.zeros(WORDS + HEADS)
    for d, y in zip(docs, labels, strict=True):
        own = np.concatenate([np.unique(d // HEADS), WORDS + np.unique(d % HEADS)])
        with_any[own] += 1
        with_toxic[own] += y
    return with_toxic, with_any


def contrast(with_toxic: np.ndarray, with_any: np.ndarray, n1: float, n: float) -> np.ndarray:
    """How much oftener ``n1`` toxic documents hold each bucket than the clean ones among ``n``,
    in standard errors beyond 2.5 (so that a few chance meetings count nothing), scaled
    and clipped."""
    p = (with_any + 0.5) / (n + 1)
    error = np.sqrt(p * (1 - p) * (1 / max(n1, 1) + 1 / max(n - n1, 1)))
    z = (with_toxic / max(n1, 1) - (with_any - with_toxic) / max(n - n1, 1)) / error
    return np.clip(np.sign(z) * np.maximum(np.abs(z) - 2.5, 0) / 3, -3, 3).astype(np.float32)


def new_model(first: np.ndarray, seed: int = 7) -> Model:
    """Random weights, but for the first dimension: it starts as ``first``, the contrast of words
    and heads, and the first filter of each width starts by adding it up."""
    r = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)
    word, head = normal(WORDS, DIM, scale=0.05), normal(HEADS, DIM, scale=0.05)
    word[:, 0], head[:, 0] = first[:WORDS], first[WORDS:]
    word[PAD] = 0
    filters = [normal(w, DIM, FILTERS, scale=0.1) for w in WIDTHS]
    n = FILTERS * len(WIDTHS)
    out = normal(n, scale=0.1)
    for i, f in enumerate(filters):
        f[:, :, 0] = 0
        f[:, 0, 0] = 1
        out[i * FILTERS] = 1
    return Model(word, head, filters, np.zeros(n, np.float32), out, -2.0)


def _weights(m: Model) -> np.ndarray:
    """All weights of a model as one vector."""
    return np.concatenate([*(w.ravel() for w in (m.word, m.head, *m.filters, m.bias, m.out)),
                           [m.out_bias]]).astype(np.float32)


def _with_weights(m: Model, flat: np.ndarray) -> Model:
    """A model of the same shape with other weights."""
    parts, at = [], 0
    for w in (m.word, m.head, *m.filters, m.bias, m.out):
        parts.append(flat[at:at + w.size].reshape(w.shape).copy())
        at += w.size
    return replace(m, word=parts[0], head=parts[1], filters=parts[2:-2], bias=parts[-2],
                   out=parts[-1], out_bias=float(flat[at]))


def _layers(m: Model, docs: list[np.ndarray], begins: list[int] | None = None) -> tuple:
    """Pad and join documents; filter answers at all places; each document's first place.

    ``begins``: how many places of each document filters begin at (default: all)."""
    gap = np.full(max(WIDTHS), PAD * HEADS, np.int64)
    flat = np.concatenate([x for d in docs for x in (d, gap)])
    starts = np.cumsum([0] + [len(d) + len(gap) for d in docs[:-1]])
    w, h = flat // HEADS, flat % HEADS
    x = m.word[w] + m.head[h]
    x[w == PAD] = 0
    answers = np.empty((len(flat), FILTERS * len(WIDTHS)), np.float32)
    for i, f in enumerate(m.filters):
        part = x @ f[0]
        for o in range(1, len(f)):
            part[:-o] += x[o:] @ f[o]
        answers[:, i * FILTERS:(i + 1) * FILTERS] = part
    # A filter may begin at a document's words, and behind the last one on padding only: from
    # there on it would reach the next document.
    sizes = [len(d) + len(gap) for d in docs]
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    answers[place >= np.repeat([len(d) + 1 for d in docs] if begins is None else begins, sizes)] = -np.inf
    return w, h, x, answers, starts


def raw_scores(m: Model, docs: list[np.ndarray], size: int = 65_536) -> np.ndarray:
    """Probability before calibration of each document's word numbers.

    The filters run over at most ``size`` words at a time; the slices of a longer document
    overlap by the widest filter, and each filter's best answer is kept over all of them."""
    overlap = max(WIDTHS) - 1
    cut = [(i, d[lo:lo + size + overlap], size if lo + size < len(d) else len(d) - lo + 1)
           for i, d in enumerate(docs) for lo in range(0, max(len(d), 1), size)]
    best = np.full((len(docs), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    at = 0
    while at < len(cut):
        end, words = at, 0
        while end < len(cut) and (end == at or words + len(cut[end][1]) <= size):
            words += len(cut[end][1])
            end += 1
        part = cut[at:end]
        _, _, _, answers, starts = _layers(m, [d for _, d, _ in part], [n for *_, n in part])
        np.maximum.at(best, [i for i, *_ in part],
                      np.maximum.reduceat(answers, starts, axis=0))
        at = end
    pooled = np.maximum(best + m.bias, 0)
    return 1 / (1 + np.exp(-np.clip((pooled @ m.out + m.out_bias).astype(float), -30, 30)))


def train(docs: list[np.ndarray], labels: np.ndarray, steps: int = 700, batch: int = 64,
          rate: float = 0.1, seed: int = 7, start: Model | None = None) -> Model:
    """About ``steps`` steps of Adagrad on the logistic loss, from ``start`` (changed in place)
    or a new model.  Gradients flow through each filter's best place only."""
    m = start or new_model(contrast(*bucket_counts(docs, labels), labels.sum(), len(docs)), seed)
    r = np.random.default_rng(seed)
    seen = {k: np.full_like(getattr(m, k), 1e-2) for k in ("word", "head", "bias", "out")}
    seen_filters = [np.full_like(f, 1e-2) for f in m.filters]
    columns = np.arange(FILTERS * len(WIDTHS))
    order = np.argsort([len(d) for d in docs], kind="stable")    # batches of like lengths
    batches = [order[i:i + batch] for i in range(0, len(order), batch)]
    for _ in range(max(1, min(30, -(-steps // len(batches))))):
        for b in r.permutation(len(batches)):
            some = [docs[i] for i in batches[b]]
            w, h, x, answers, starts = _layers(m, some)
            ends = np.append(starts[1:], len(w))
            best = np.stack([s + answers[s:e].argmax(0) for s, e in zip(starts, ends, strict=True)])
            value = answers[best, columns] + m.bias
            pooled = np.maximum(value, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ m.out + m.out_bias, -30, 30)))
            err = ((p - labels[batches[b]]) / len(some)).astype(np.float32)
            g_out = pooled.T @ err
            g_pool = np.outer(err, m.out) * (value > 0)
            m.out_bias -= rate * float(err.sum())
            for k, g in (("out", g_out), ("bias", g_pool.sum(0))):
                seen[k] += g * g
                getattr(m, k)[...] -= rate * g / np.sqrt(seen[k])
            gx_rows, gx = [], []
            for i, f in enumerate(m.filters):
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                g, at = g_pool[:, cols], best[:, cols]
                g_f = np.zeros_like(f)
                for o in range(len(f)):
                    place = np.minimum(at + o, len(w) - 1)
                    g_f[o] = np.einsum("df,dfk->kf", g, x[place])
                    gx_rows.append(place.reshape(-1))
                    gx.append((g[:, :, None] * f[o].T[None]).reshape(-1, DIM))
                seen_filters[i] += g_f * g_f
                f -= rate * g_f / np.sqrt(seen_filters[i])
            rows, grads = np.concatenate(gx_rows), np.concatenate(gx)
            real = (w[rows] != PAD) & np.any(grads, axis=1)
            for k, ids in (("word", w), ("head", h)):
                who, at = np.unique(ids[rows[real]], return_inverse=True)
                g = np.zeros((len(who), DIM), np.float32)
                np.add.at(g, at, grads[real])
                seen[k][who] += g * g
                getattr(m, k)[who] -= rate * g / np.sqrt(seen[k][who])
    return m


def _odds(v: np.ndarray) -> np.ndarray:
    v = np.clip(v, 1e-9, 1 - 1e-9)
    return np.log(v / (1 - v))


def score_bin(scores: np.ndarray) -> np.ndarray:
    """The number of the bin, ``1 / BINS`` wide in log odds, of each score."""
    return np.floor(_odds(scores) * BINS).astype(np.int64)


def best_threshold(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The cut between two bins with the highest F1; the middle, in log odds, of the gap it lies in.

    Of each bin: its lowest and highest score, and how many toxic rows and rows it has."""
    order = np.argsort(-low, kind="stable")
    low, high, toxic, n = low[order], high[order], toxic[order], n[order]
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(n) + toxic.sum())
    i = int(f1.argmax())
    below = high[i + 1] if i + 1 < len(low) else low[i] / 2
    return float(1 / (1 + np.exp(-(_odds(low[i]) + _odds(below)) / 2)))


def calibrated(raw: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Scores 0 to 1 in the same order within a language, with its threshold at ``CUT``."""
    cut = np.clip(cut, 1e-6, 1 - 1e-6)
    return np.where(raw >= cut, CUT + (1 - CUT) * (raw - cut) / (1 - cut), CUT * raw / cut)


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, doc_id: str = "doc_id",
        text: str = "text", lang: str = "lang", label: str = "toxic", sample_rows: int = 24_000,
        steps: int = 700, profile_rows: int | None = None) -> Model | None:
    """Train on every labelled row: three quarters teach, a quarter calibrates the thresholds.

    Rows are dealt out by a hash of their id to shards of about ``sample_rows`` rows.  In
    rounds, each shard goes once through its rows from the model so far, and the shards'
    weights are averaged, until a shard has made about ``steps`` steps.  A single shard makes
    its steps in one round.  What words tell beforehand, and the thresholds, are counted over all
    rows on the executors.

    Only rows where ``train_rows`` teach.  Labels other than 0 and 1, and null ids, are
    ignored; an id labelled twice counts as toxic if one label says so; of documents that
    share an id the one with the smallest text teaches; null texts are empty.  None if a
    class has no row.  ``lang`` only names the profiles that tell a text's language, fitted
    on all rows (or about ``profile_rows`` of each language).
    """
    known = labels.where(train_rows & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).cast("long").alias("key")).agg(F.max(label).alias("y"))
    profiles = train_profiles(docs, train_rows, text, lang, doc_id,
                              sample_rows=profile_rows or 1 << 40)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, matcher = WordHash(), Matcher(profiles)
        for f in frames:
            for lo in range(0, len(f), ROWS):
                part = f.iloc[lo:lo + ROWS]
                yield pd.DataFrame({
                    "key": part["key"], "y": part["y"],
                    "aside": [zlib.crc32(str(k).encode()) // 3 % 4 == 0 for k in part["key"]],
                    "ids": [hashed(t).astype(np.uint32).tobytes() for t in part["text"]],
                    "lang": [matcher.predict(t)[0] for t in part["text"]]})
    shards = max(1, -(-known.count() // sample_rows))
    # Text and label meet by shuffle: the labels grow with the documents.
    rows = docs.where(train_rows).select(
        docs[doc_id].cast("long").alias("key"), docs[text].cast("string").alias("text")).join(
        known.hint("shuffle_hash"), "key").groupBy("key", "y").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text")).mapInPandas(
        run, "key long, y int, aside boolean, ids binary, lang string")
    # Every step and round reads the shards where they lie, without a further shuffle.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).repartition(
        shards, "shard").persist(StorageLevel.DISK_ONLY)
    try:
        return _fitted(rows, profiles, shards, steps)
    finally:
        rows.unpersist()


def _fitted(rows: DataFrame, profiles: dict[str, np.ndarray], shards: int,
            steps: int) -> Model | None:
    """The model of the hashed rows, calibrated; None if a class has no row."""
    sizes = {(r.aside, r.y): r["count"] for r in rows.groupBy("aside", "y").count().collect()}
    if {y for _, y in sizes} != {0, 1}:
        return None
    if min(sizes.get((True, y), 0) for y in (0, 1)) < 10 or len([a for a, _ in sizes if not a]) < 2:
        teach = held = rows                                 # too few rows to set some aside
        n0, n1 = (sum(n for (_, c), n in sizes.items() if c == y) for y in (0, 1))
    else:
        teach, held = rows.where("NOT aside"), rows.where("aside")
        n0, n1 = sizes[False, 0], sizes[False, 1]
    model = _train_sharded(teach, n1, n0 + n1, shards, steps)
    model.profiles = profiles
    _calibrate(model, held)
    return model


def _documents(ids: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint32).astype(np.int64) for b in ids]


def _train_sharded(rows: DataFrame, n1: int, n: int, shards: int, steps: int,
                   batch: int = 64) -> Model:
    """A model trained on ``rows``, of which ``n1`` of ``n`` are toxic, in ``shards``."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, WORDS + HEADS))
        for f in frames:
            for lo in range(0, len(f), ROWS):
                part = f.iloc[lo:lo + ROWS]
                total += bucket_counts(_documents(part["ids"]), part["y"].to_numpy(float))
        at = np.flatnonzero(total[1])
        yield pd.DataFrame({"bucket": at, "toxic": total[0][at], "n": total[1][at]})
    counts = np.zeros((2, WORDS + HEADS))
    for r in rows.select("ids", "y").mapInPandas(
            count, "bucket long, toxic double, n double").groupBy("bucket").agg(
            F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).collect():   # as many as buckets
        counts[:, r.bucket] = r.toxic, r.n
    model = new_model(contrast(*counts, n1, n))
    spark = rows.sparkSession
    own = rows.select("key", "y", "ids", "shard")
    rounds = 1 if shards == 1 else max(1, min(30, -(-steps * batch * shards // n)))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)        # about 3 MB, a fixed size
        found = own.groupBy("shard").applyInPandas(
            _teacher(shared, steps if shards == 1 else 1, batch, 7 + turn),
            "chunk long, shard long, n long, weights binary").groupBy("chunk").applyInPandas(
            _averaged, "chunk long, weights binary").collect()
        found.sort(key=lambda r: r.chunk)
        model = _with_weights(model, np.frombuffer(b"".join(r.weights for r in found), np.float32))
        shared.unpersist()
    return model


def _teacher(shared: Broadcast, steps: int, batch: int,
             seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Trains a shard's rows from the shared model; its weights in chunks."""
    def teach(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("key")
        start = _with_weights(shared.value, _weights(shared.value))
        flat = _weights(train(_documents(f["ids"]), f["y"].to_numpy(float), steps, batch,
                              seed=seed, start=start))
        chunks = [flat[lo:lo + CHUNK].tobytes() for lo in range(0, len(flat), CHUNK)]
        return pd.DataFrame({"chunk": range(len(chunks)), "shard": f["shard"].iloc[0],
                             "n": len(f), "weights": chunks})
    return teach


def _averaged(f: pd.DataFrame) -> pd.DataFrame:
    """The mean of the shards' weights, by their rows."""
    f = f.sort_values("shard")
    mean = sum(np.frombuffer(w, np.float32).astype(float) * n
               for w, n in zip(f["weights"], f["n"], strict=True)) / f["n"].sum()
    return pd.DataFrame({"chunk": [f["chunk"].iloc[0]],
                         "weights": [mean.astype(np.float32).tobytes()]})


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Set the thresholds, of all rows together and of each language, by counts in score bins."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lo in range(0, len(f), 64):
                part = f.iloc[lo:lo + 64]
                scores = raw_scores(shared.value, _documents(part["ids"]))
                yield pd.DataFrame({"lang": part["lang"], "bin": score_bin(scores),
                                    "y": part["y"].astype(int), "score": scores})
    # Bins of a language are at most as many as log odds from -21 to 21 have.
    bins = rows.select("lang", "y", "ids").mapInPandas(
        run, "lang string, bin long, y long, score double").groupBy("lang", "bin").agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.sum("y").alias("toxic"),
        F.count("*").alias("n")).toPandas()

    def threshold(b: pd.DataFrame) -> float:
        b = b.groupby("bin").agg({"low": "min", "high": "max", "toxic": "sum", "n": "sum"})
        return best_threshold(*(b[c].to_numpy(float) for c in ("low", "high", "toxic", "n")))
    model.threshold = threshold(bins)
    for name, own in bins.groupby("lang"):
        if min(own["toxic"].sum(), (own["n"] - own["toxic"]).sum()) >= 10:
            model.thresholds[name] = threshold(own)


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, score, predicted``: calibrated score of every whole text, 1 from 0.7 on.

    Null and empty texts are scored as texts without words.  Without a model (no labels
    of both classes) every score is 0.  Repeated rows and ids each keep their row; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)            # about 3 MB, a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        hashed = WordHash()
        matcher = Matcher(m.profiles) if m else None
        for keys, texts in text_batches(batches, 200_000):
            if m is None:
                found = np.zeros(len(texts))
            else:
                cuts = [m.thresholds.get(matcher.predict(t)[0], m.threshold) for t in texts]
                found = calibrated(raw_scores(m, [hashed(t) for t in texts]), np.array(cuts))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(found, pa.float64()),
                pa.array((found >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])
    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int")
