"""Exact top-k search by distributed histogram selection.

Scores are integers, so the k-th best score of a query can be located exactly:
every pass scores all candidates against all queries, block by block, counts
each query's scores in bins of its current interval, adds the counts up, and
narrows the interval to the bin that holds the k-th score, until a bin is one
score wide.  A last pass keeps what scores higher, and of the ties the smallest
ids that still fit.

A block of candidates sends only its bins from its own k-th best score up: the
global k-th score is never below a block's own, so lower bins cannot hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CANDIDATE_ROWS, QUERY_ROWS, BINS = 4096, 512, 4096
TILE = 16           # blocks of a side that meet the other side's in one cell


def quantise(vectors: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """``vec_id, dim, v``: floor(scale * x) as longs; rows that are null, or hold a null
    or a non-finite component, leave."""
    v = F.col(vector).cast("array<double>")
    whole = F.transform(v, lambda x: F.floor(x * scale))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & ok)
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.size(v).alias("dim"),
                    whole.cast("array<long>").alias("v")))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as int64: by floating point where that is exact, else by integers.

    Products that leave 64 bits wrap, as Spark's long arithmetic does."""
    q, r = np.abs(queries.astype(float)), np.abs(rows.astype(float))
    if (q.max(initial=0) * r.max(initial=0) * queries.shape[1]) < 2.0 ** 53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows in blocks of at most ``size``: ``<name>, dim, ids, data`` (packed longs)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        base, n = TaskContext.get().partitionId() << 32, 0
        for frame in frames:
            for dim, part in frame.groupby("dim", sort=True):
                for lo in range(0, len(part), size):
                    some = part.iloc[lo:lo + size]
                    data = np.stack([np.asarray(v, "<i8") for v in some["v"]]).reshape(
                        len(some), int(dim))
                    yield pd.DataFrame({name: [base + n], "dim": [int(dim)], "ids": [
                        some["vec_id"].to_numpy("<i8").tobytes()], "data": [data.tobytes()]})
                    n += 1
    return rows.mapInPandas(run, f"{name} long, dim int, ids binary, data binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
          vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each query by
    integer inner product, ties to the smaller ``vec_id``; a row is never its own result.

    All candidates are scored exactly.  Fewer than k candidates give fewer rows.
    Vectors that are null or hold null or non-finite components take no part, nor do
    rows without an id; vectors of different lengths do not meet.  Components whose
    scores might go beyond 2**61 raise an error (64-bit sums).  Of queries with
    the same id one takes part; candidates with the same id are each a candidate.
    Empty tables give no rows.  Other columns are ignored.
    """
    if k < 1:
        raise ValueError("k must be positive")
    cands = written(_blocks(quantise(vectors, vec_id, vector, scale), CANDIDATE_ROWS, "cand"),
                    "candidates")
    asked = quantise(queries, vec_id, vector, scale).dropDuplicates(["vec_id"])
    asks = written(_blocks(asked, QUERY_ROWS, "block"), "queries")
    # Candidate blocks and query blocks are dealt into tiles; a candidate tile and a query tile
    # of one length meet in a cell of the grid, so a block is shuffled once per tile of the
    # other side, not once per block.  Inside its cell a block meets every block.
    n_cands, n_asks = cands.count(), asks.count()
    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, min(n_cands, max(-(-n_cands // TILE), parallel)))
    down = max(1, -(-n_asks // TILE))

    def tile(block: str, n: int):
        return F.pmod(F.xxhash64(block), F.lit(n)).cast("int")

    def scored(state: DataFrame, run, schema: str) -> DataFrame:
        held = asks.join(state, "block").select(
            F.col("ids").alias("qids"), F.col("data").alias("qdata"), "dim", "lo", "width", "need",
            tile("block", down).alias("down"),
            F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"))
        rows = cands.select("ids", "data", "dim", tile("cand", across).alias("across"),
                            F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"))
        return (rows.join(held, ["dim", "across", "down"])
                .select("ids", "data", "qids", "qdata", "dim", "lo", "width", "need")
                .mapInPandas(run, schema))

    def unpack(row):
        ids, qids = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.qids, "<i8")
        score = _scores(np.frombuffer(row.qdata, "<i8").reshape(len(qids), row.dim),
                        np.frombuffer(row.data, "<i8").reshape(len(ids), row.dim))
        lo, width, need = (np.frombuffer(x, "<i8") for x in (row.lo, row.width, row.need))
        return ids, qids, score, lo, width, need, qids[:, None] != ids[None, :]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, qids, score, lo, width, need, other = unpack(row)
                bins = (score - lo[:, None]) // width[:, None]
                np.clip(bins, -1, BINS, out=bins)      # -1: below; BINS: above the interval
                bins += 1
                bins[~other] = 0
                flat = bins + (BINS + 2) * np.arange(len(qids))[:, None]
                hist = np.bincount(flat.reshape(-1), minlength=len(qids) * (BINS + 2)).reshape(
                    len(qids), BINS + 2)[:, 1:BINS + 1]
                above = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1] - hist
                q, b = np.nonzero((hist > 0) & (above < need[:, None]))
                yield pd.DataFrame({"query_id": qids[q], "bin": b, "n": hist[q, b]})

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, qids, score, lo, width, need, other = unpack(row)
                better = (score > lo[:, None]) & other
                q, c = np.nonzero(better)
                parts = [(q, c)]
                tq, tc = np.nonzero((score == lo[:, None]) & other)
                order = np.lexsort((ids[tc], tq))
                tq, tc = tq[order], tc[order]
                place = np.arange(len(tq)) - np.searchsorted(tq, tq)
                fits = place < need[tq]
                parts.append((tq[fits], tc[fits]))
                q, c = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pd.DataFrame({"query_id": qids[q], "vec_id": ids[c],
                                    "score": score[q, c]})

    # Bounds of all scores, from the largest component sum: |score| <= max|q|_1 * max|c|_inf.
    def limit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, data, dim in zip(frame["ids"], frame["data"], frame["dim"], strict=True):
                a = np.abs(np.frombuffer(data, "<i8").reshape(len(ids) // 8, dim).astype(float))
                yield pd.DataFrame({"high": [a.max(initial=0)],
                                    "total": [a.sum(axis=1).max(initial=0)]})
    high = cands.select("ids", "data", "dim").mapInPandas(limit, "high double, total double").agg(
        F.max("high")).first()[0] or 0.0
    total = asks.select("ids", "data", "dim").mapInPandas(limit, "high double, total double").agg(
        F.max("total")).first()[0] or 0.0
    if high * total >= 2.0 ** 61:
        raise ValueError("scores may go beyond 2**61, which 64-bit sums don't hold")
    reach = int(high * total) + 1
    width = 1                      # a power of BINS, so that bins nest exactly
    while width * BINS <= 2 * reach:
        width *= BINS

    # State per query: interval start, bin width, and how many of the k lie inside it.
    def packed(state: DataFrame | None) -> DataFrame:
        """The state next to its query block, as packed arrays in the block's order."""
        ids = asks.select("block", "ids")
        if state is None:
            def first(frames):
                for f in frames:
                    n = [len(x) // 8 for x in f["ids"]]
                    yield pd.DataFrame({"block": f["block"], **{
                        c: [np.full(m, v, "<i8").tobytes() for m in n]
                        for c, v in (("lo", -reach), ("width", width), ("need", k))}})
            return ids.mapInPandas(first, "block long, lo binary, width binary, need binary")
        spread = asks.select("block", "ids").mapInPandas(
            lambda frames: (pd.DataFrame({"block": b, "query_id": np.frombuffer(x, "<i8"),
                                          "place": np.arange(len(x) // 8)})
                            for f in frames for b, x in zip(f["block"], f["ids"], strict=True)),
            "block long, query_id long, place int")
        # A query without candidates keeps an empty interval above every score.
        rows = spread.join(state, "query_id", "left").select(
            "block", "place", F.coalesce("lo", F.lit(2 ** 62)).alias("lo"),
            F.coalesce("width", F.lit(1)).alias("width"),
            F.coalesce("need", F.lit(0)).alias("need"))

        def gather(key: tuple, f: pd.DataFrame) -> pd.DataFrame:    # at most QUERY_ROWS rows
            f = f.sort_values("place")
            return pd.DataFrame({"block": [key[0]], **{
                c: [f[c].to_numpy("<i8").tobytes()] for c in ("lo", "width", "need")}})
        return rows.groupBy("block").applyInPandas(
            gather, "block long, lo binary, width binary, need binary")

    state = packed(None)
    known: DataFrame | None = None
    while True:
        counts = scored(state, count, "query_id long, bin int, n long").groupBy(
            "query_id", "bin").agg(F.sum("n").alias("n"))
        top = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        upto = top.rowsBetween(Window.unboundedPreceding, 0)
        at = counts.withColumn("upto", F.sum("n").over(upto))
        if known is None:
            base = at.withColumn("lo", F.lit(-reach)).withColumn("width", F.lit(width)
                                                                 ).withColumn("need", F.lit(k))
        else:
            base = at.join(known, "query_id")
        # The highest bin at which the count reaches ``need``; the lowest one if none does.
        hit = base.groupBy("query_id").agg(
            F.coalesce(F.max(F.when(F.col("upto") >= F.col("need"), F.col("bin"))),
                       F.min("bin")).alias("bin"), F.first("lo").alias("lo"),
            F.first("width").alias("width"), F.first("need").alias("need"),
            F.map_from_entries(F.collect_list(F.struct("bin", F.col("upto") - F.col("n"))))
            .alias("above"))
        next_width = max(1, width // BINS)
        known = written(hit.select(
            "query_id", (F.col("lo") + F.col("bin") * F.col("width")).cast("long").alias("lo"),
            F.lit(next_width).cast("long").alias("width"),
            (F.col("need") - F.col("above")[F.col("bin")]).cast("long").alias("need")),
            "thresholds")
        state = written(packed(known), "state")
        if width == 1:
            break
        width = next_width
    best = scored(state, keep, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
