"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``tau`` or fewer differing bits.  Bits that
correlate are grouped, groups make up the partitions, and every fingerprint
gets its own thresholds t_i per partition with sum(t_i + 1) = tau + 1 (t_i = -1
skips a partition).  A pair within tau bits must then agree to within t_i bits
in some partition.  A dynamic program picks the thresholds that cost least by
estimated candidate counts, so a value shared by many fingerprints is skipped
where another partition is cheaper.  Probes meet exact partition values in an
equi-join, and each candidate pair is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import small_batches, text_batches, written

GROUPS, WIDTH = 4, 16              # correlated groups of bits
KEY_COST = 20.0                    # shuffling one key costs as much as so many comparisons
CHUNK = 50_000                     # shingles hashed at a time


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of one text: words between ASCII white space, A-Z lowered,
    ``shingle`` words each (fewer words: all of them), XXH64 with seed 42, a bit
    set if set in more than half of the hashes.  No words: 0."""
    import xxhash
    digest, join = xxhash.xxh64_intdigest, b" ".join
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        part = words[lo:lo + CHUNK + shingle - 1]
        if len(words) < shingle:
            hashes = [digest(join(words), 42)]
        else:
            hashes = [digest(join(s), 42)
                      for s in zip(*(part[i:] for i in range(shingle)), strict=False)]
        raw = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: each row's SimHash as a signed long.  Null text reads as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps)],
                                             ["doc_id", "fp"])
    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    """(n, 64) bits, most significant first."""
    return np.unpackbits(fps.astype(np.int64).view(np.uint64).astype(">u8").view(np.uint8)
                         .reshape(-1, 8), axis=1)


def correlated_groups(distinct: DataFrame) -> list[list[int]]:
    """``GROUPS`` groups of ``WIDTH`` bit positions, grown from the strongest correlations.

    The 64 x 64 co-occurrence counts of all fingerprints are summed in Spark."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((64, 64)), 0
        for f in frames:
            b = _bits(f["fp"].to_numpy()).astype(np.float32)
            total += b.T @ b
            n += len(f)
        yield pd.DataFrame({"cell": np.arange(4097), "n": np.append(total.reshape(-1), n)})
    cells = {r.cell: r.n for r in distinct.select("fp").mapInPandas(run, "cell int, n double")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    n = max(cells.get(4096, 0.0), 1.0)
    both = np.array([cells.get(i, 0.0) for i in range(4096)]).reshape(64, 64) / n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(np.outer(mean * (1 - mean), mean * (1 - mean)), 1e-12))
    corr = np.abs(both - np.outer(mean, mean)) / spread
    np.fill_diagonal(corr, 0)
    free, groups = list(range(64)), []
    for _ in range(GROUPS):
        sub = corr[np.ix_(free, free)]
        group = [free[int(sub.sum(1).argmax())]]
        while len(group) < WIDTH:
            rest = [b for b in free if b not in group]
            group.append(rest[int(corr[np.ix_(rest, group)].sum(1).argmax())])
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def _values(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return bits[:, group].astype(np.int64) @ (1 << np.arange(WIDTH))


def value_shares(distinct: DataFrame, groups: list[list[int]], tau: int) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and shares[g, e, v]: the part of them whose value of group g
    differs from v in exactly e bits.  At most GROUPS * 2**WIDTH counts reach the driver."""
    size = 1 << WIDTH

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((GROUPS, size), np.int64)
        for f in frames:
            bits = _bits(f["fp"].to_numpy())
            for g, group in enumerate(groups):
                total[g] += np.bincount(_values(bits, group), minlength=size)
        g, v = np.nonzero(total)
        yield pd.DataFrame({"g": g, "v": v, "n": total[g, v]})
    found = distinct.select("fp").mapInPandas(run, "g int, v int, n long").groupBy("g", "v").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros((GROUPS, size))
    counts[found["g"], found["v"]] = found["n"]
    n = int(counts[0].sum())
    at, shares = np.arange(size), np.zeros((GROUPS, tau + 1, size))
    for g in range(GROUPS):
        shares[g, 0] = counts[g] / max(n, 1)
        for e in range(1, tau + 1):
            near = sum(shares[g, e - 1][at ^ (1 << b)] for b in range(WIDTH))
            back = (WIDTH - e + 2) * shares[g, e - 2] if e > 1 else 0
            shares[g, e] = np.maximum(near - back, 0) / e
    return n, shares.astype(np.float32)


def choose_parts(n: int, shares: np.ndarray, tau: int) -> int:
    """Number of partitions (4 of 16 bits or 2 of 32) with the smaller expected cost."""
    same = (shares * shares[:, :1]).sum(2)          # chance that two rows differ in e bits
    best = {}
    for parts in (GROUPS, GROUPS // 2):
        t = (tau + 1) // parts - 1
        if t < 0:
            continue
        per = GROUPS // parts
        cost = 0.0
        for p in range(parts):
            keys = sum(_binomial(WIDTH * per, e) for e in range(t + 1))
            dist = np.array([1.0])
            for g in range(p * per, p * per + per):
                dist = np.convolve(dist, same[g])[:t + 1]
            cost += KEY_COST * keys + n * dist.sum()
        best[parts] = cost
    return min(best, key=best.get) if best else GROUPS // 2


def _binomial(n: int, k: int) -> int:
    from math import comb
    return comb(n, k)


def allocate(costs: np.ndarray, tau: int) -> np.ndarray:
    """Thresholds (rows, parts) in -1..tau with sum(t + 1) = tau + 1 and least cost.

    ``costs[r, p, u]`` is the cost of u = t + 1 in partition p (u = 0 is free)."""
    rows, parts, options = costs.shape
    best = np.full((rows, tau + 2), np.inf)
    best[:, 0] = 0
    picks = np.zeros((parts, rows, tau + 2), np.int64)
    for p in range(parts):
        nxt = np.full_like(best, np.inf)
        for u in range(options):
            for total in range(u, tau + 2):
                c = best[:, total - u] + costs[:, p, u]
                better = c < nxt[:, total]
                nxt[better, total] = c[better]
                picks[p, better, total] = u
        best = nxt
    out, left = np.empty((rows, parts), np.int64), np.full(rows, tau + 1)
    for p in range(parts - 1, -1, -1):
        u = picks[p, np.arange(rows), left]
        out[:, p] = u - 1
        left -= u
    return out


def links(distinct: DataFrame, tau: int = 3) -> DataFrame:
    """``a, b``: all pairs of distinct fingerprints (a < b) at ``tau`` or fewer differing bits.

    ``distinct`` has one row per fingerprint in column ``fp``."""
    spark = distinct.sparkSession
    groups = correlated_groups(distinct)
    n, shares = value_shares(distinct, groups, tau)
    parts = choose_parts(n, shares, tau)
    per = GROUPS // parts
    wide = WIDTH * per
    tables = spark.sparkContext.broadcast(shares)   # GROUPS * (tau + 1) * 2**WIDTH floats

    def part_values(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = _bits(fps)
        small = np.stack([_values(bits, g) for g in groups], 1)
        joined = np.zeros((len(fps), parts), np.int64)
        for g in range(GROUPS):
            joined[:, g // per] |= small[:, g] << (WIDTH * (g % per))
        return small, joined

    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = f["fp"].to_numpy()
            _, joined = part_values(fps)
            yield pd.DataFrame({"key": (joined + (np.arange(parts) << 40)).reshape(-1),
                                "b": np.repeat(fps, parts)})

    # Flips of e bits of a partition.  A threshold above 2 on 32 bits would be 5,489 keys;
    # with two partitions (1, 1) or (2, 0) always does, up to tau = 5.
    most = tau if parts == GROUPS else min(tau, 2)
    balls = [np.array([sum(1 << i for i in c) for c in combinations(range(wide), e)], np.int64)
             for e in range(most + 1)]

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share = tables.value
        for f in frames:
            fps = f["fp"].to_numpy()
            small, joined = part_values(fps)
            costs = np.full((len(fps), parts, tau + 2), np.inf)
            costs[:, :, 0] = 0
            for p in range(parts):
                dist = np.ones((len(fps), 1))
                for g in range(p * per, p * per + per):
                    own = share[g][:, small[:, g]].T
                    new = np.zeros((len(fps), tau + 1))
                    for e in range(tau + 1):
                        for d in range(min(e + 1, dist.shape[1])):
                            new[:, e] += dist[:, d] * own[:, e - d]
                    dist = new
                upto = np.cumsum(dist, axis=1) * n
                for t in range(most + 1):
                    keys = sum(len(balls[e]) for e in range(t + 1))
                    costs[:, p, t + 1] = KEY_COST * keys + upto[:, t]
            chosen = allocate(costs, tau)
            for p in range(parts):
                for e in range(most + 1):
                    rows = np.flatnonzero(chosen[:, p] >= e)
                    size = max(1, 200_000 // len(balls[e]))      # keys held at a time
                    for lo in range(0, len(rows), size):
                        some = rows[lo:lo + size]
                        keys = joined[some, p][:, None] ^ balls[e][None, :]
                        yield pd.DataFrame({"key": keys.reshape(-1) + (p << 40),
                                            "a": np.repeat(fps[some], len(balls[e]))})

    stored = distinct.select("fp").mapInPandas(store, "key long, b long")
    probes = distinct.select("fp").mapInPandas(probe, "key long, a long")
    return probes.join(stored, (probes.key == stored.key) & (F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau)).select("a", "b")


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Star edges of the components that this task's own edges form."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x
    for f in frames:
        for a, b in zip(f["a"].tolist(), f["b"].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
    pairs = [(find(x), x) for x in root if find(x) != x]
    yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node each node can reach, for every node with an edge.

    Edges are first thinned to a forest inside each task, then alternate large-star
    and small-star steps run until nothing changes.  Each round is written to the
    shared folder; stars are joins and minima by key, so a hub is split or combined
    before the shuffle."""
    def low(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def total(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    now = written(edges.mapInPandas(_forest, "a long, b long").distinct(), "edges")
    state = total(now)
    while state[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(low(both), "u").where("v > u").select(
            F.least("m", "u").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        mins = low(down)
        small = down.join(mins, "u").where("v <> m").select(
            F.col("m").alias("a"), F.col("v").alias("b")).union(
            mins.select(F.col("m").alias("a"), F.col("u").alias("b"))).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        now = written(small, "edges")
        before, state = state, total(now)
        if state == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _labelled(docs: DataFrame, doc_id: str, text: str, shingle: int, tau: int) -> DataFrame:
    """``near_duplicates`` with ``low_fp``: in each component the smallest fingerprint of
    the rows with its smallest id (of all its rows, if none has an id)."""
    fps = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    comps = written(components(links(distinct, tau)), "components")
    named = distinct.join(comps, distinct.fp == comps.node).select("fp", "root", "first_id")
    lowest = named.groupBy("root").agg(F.min(F.struct(
        F.col("first_id").isNull(), "first_id", "fp")).alias("low"))
    linked = named.join(lowest, "root").select(F.col("fp").alias("linked_fp"), "low")
    # Written, so that the last join's sides are plain exchanges: AQE then splits the
    # partition of a fingerprint that very many rows share.
    label = written(distinct.join(linked, distinct.fp == linked.linked_fp, "left").select(
        F.col("fp").alias("label_fp"),
        F.coalesce("low.first_id", "first_id").alias("component_id"),
        F.coalesce("low.fp", "fp").alias("low_fp")), "labels")
    return fps.join(label, fps.fp == label.label_fp).select(
        "doc_id", "fp", "component_id", "low_fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, tau: int = 3) -> DataFrame:
    """``doc_id, fp, component_id``, a row per document: its fingerprint (signed long) and
    the smallest doc_id that chains of links reach, itself included.

    Null, empty and blank texts have fingerprint 0 and link like any other.  Rows
    without an id get a component too (null only if no document of it has an id).
    Repeated rows and ids each keep their row.  An empty table gives no rows; other
    columns are ignored.
    """
    return _labelled(docs, doc_id, text, shingle, tau).select("doc_id", "fp", "component_id")


def _with_fingerprint(docs: DataFrame, name: str, text: str, shingle: int) -> DataFrame:
    """``docs`` with the fingerprint of each row in a further column."""
    texts = docs.select(*docs.columns, docs[text].cast("string").alias(f"{name}_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fps = np.array([fingerprint(t or "", shingle) for t in
                            batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))],
                                             [*batch.schema.names[:-1], name])
    return texts.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle: int = 3, tau: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: one row of each, with
    the group's smallest id, or of a group without any id one of its rows.  Rows that
    share an id, or have none, are told apart by their fingerprints; of those that share
    both the one whose columns hash lowest stays.

    Only ids are shuffled: the list of ids that go is written first, so that its size
    is known and Spark broadcasts it only below its threshold.  Texts are shuffled of
    rows whose id repeats or is null.  Texts of any length are read whole.
    """
    found = written(_labelled(docs, doc_id, text, shingle, tau).select(
        "doc_id", "fp", (F.col("doc_id").eqNullSafe(F.col("component_id"))
                         & (F.col("fp") == F.col("low_fp"))).alias("stays")), "groups")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("stays").alias("stays"), F.count("*").alias("n"))
    gone = written(ids.where(~F.col("stays")).select(F.col("doc_id").alias("gone_id")), "gone")
    twice = written(ids.where(F.col("stays") & (F.col("n") > 1)).select(
        F.col("doc_id").alias("twice_id")), "twice")
    key = docs[doc_id].cast("long")
    kept = docs.where(key.isNotNull()).join(gone, key == gone.gone_id, "left_anti")
    single = kept.join(twice, key == twice.twice_id, "left_anti")
    chosen = found.where("stays").select(F.col("doc_id").alias("chosen_id"),
                                         F.col("fp").alias("chosen_fp")).distinct()
    shared = written(chosen.join(twice, F.col("chosen_id") == twice.twice_id, "left_semi"),
                     "chosen")
    unnamed = written(chosen.where("chosen_id IS NULL").drop("chosen_id"), "chosen-null")
    name = "_".join([*docs.columns, "fp"])
    double = _with_fingerprint(kept.join(twice, key == twice.twice_id, "left_semi"), name, text,
                               shingle)
    double = double.join(shared, (F.col(doc_id).cast("long") == shared.chosen_id)
                         & (F.col(name) == shared.chosen_fp), "left_semi")
    null = _with_fingerprint(docs.where(key.isNull()), name, text, shingle)
    null = null.join(unnamed, F.col(name) == unnamed.chosen_fp, "left_semi")
    row = F.struct(*docs.columns)
    told = double.unionByName(null).groupBy(F.col(doc_id).cast("long"), name).agg(
        F.min_by(row, F.xxhash64(F.to_json(row))).alias("row")).select("row.*")
    return single.unionByName(told)
