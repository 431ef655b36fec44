"""Packing documents into fixed windows by non-negative least squares.

A task reads its documents in bounded groups.  In each group every document
gives its whole windows first; what is left over has a length below the window.
Short combinations of lengths that fill a window exactly are enumerated, a
non-negative least-squares fit of repeat counts against the histogram of
lengths is rounded and applied, and what remains is packed greedily, cut at
window ends.  The last open window of a group is cut into powers of two, which
need no padding.  No row leaves its task, so no key can be hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches
from .tokens import worker_encoder

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


def combinations(hist: np.ndarray, window: int, partners: int = 8) -> np.ndarray:
    """Patterns of up to three lengths that sum to ``window``: rows (a, b, c), 0 for none.

    All pairs of present lengths, and triples whose middle member is one of the
    ``partners`` most frequent lengths.
    """
    present = np.flatnonzero(hist)
    other = window - present
    a = present[(other >= present) & (hist[other] > 0)]
    out = [np.stack([window - a, a, np.zeros_like(a)], 1)]
    for b in present[np.argsort(-hist[present], kind="stable")[:partners]]:
        c = window - b - present
        ok = (c >= 1) & (present >= c)
        ok[ok] = hist[c[ok]] > 0
        a, c = present[ok], c[ok]
        out.append(np.sort(np.stack([a, np.full_like(a, b), c], 1), axis=1)[:, ::-1])
    return np.unique(np.concatenate(out), axis=0)


def solve_counts(patterns: np.ndarray, hist: np.ndarray, rounds: int = 60) -> np.ndarray:
    """x >= 0 with a small ||A x - hist||, A[l, p] = how often pattern p uses length l.

    Multiplicative updates keep x non-negative and never raise the residual.
    """
    if not len(patterns):
        return np.zeros(0)
    used = patterns > 0
    flat, owner = patterns[used], np.nonzero(used)[0]
    target = np.bincount(owner, hist[flat].astype(float), len(patterns))
    x = target / np.maximum(used.sum(1), 1) / np.bincount(flat, minlength=len(hist))[
        patterns].max(1).clip(1)
    for _ in range(rounds):
        fitted = np.bincount(flat, x[owner], len(hist))
        x *= target / np.maximum(np.bincount(owner, fitted[flat], len(patterns)), 1e-12)
    return x


def pack_group(lengths: np.ndarray, window: int) -> np.ndarray:
    """Pieces of documents of ``lengths`` (each at least 1): rows
    (document, start, length, sequence, offset).  Sequences are full windows, but
    for the last open one, which becomes sequences of powers of two."""
    docs = np.arange(len(lengths))
    whole, rest = lengths // window, lengths % window
    first = np.cumsum(whole) - whole
    n_whole = int(whole.sum())
    owner = np.repeat(docs, whole)
    turn = np.arange(n_whole) - np.repeat(first, whole)
    out = [np.stack([owner, turn * window, np.full(n_whole, window), np.arange(n_whole),
                     np.zeros(n_whole, np.int64)], 1)]
    next_seq = n_whole
    order = docs[rest > 0]
    order = order[np.argsort(rest[order], kind="stable")]
    hist = np.bincount(rest[order], minlength=window + 1)
    take = np.cumsum(hist) - hist           # next unused document of each length, in ``order``
    left = hist.copy()
    patterns = combinations(hist, window)
    x = solve_counts(patterns, hist)
    by_count = np.argsort(-x, kind="stable")
    for want in (np.rint(x), np.full(len(x), np.inf)):   # the rounded fit, then what still fits
        for p in by_count:
            if want[p] < 1:
                continue
            parts = [int(v) for v in patterns[p] if v]
            n = int(min(want[p], *(left[v] // parts.count(v) for v in parts)))
            if n < 1:
                continue
            offset = 0
            for v in parts:
                chosen = order[take[v]:take[v] + n]
                take[v] += n
                left[v] -= n
                out.append(np.stack([chosen, whole[chosen] * window, np.full(n, v),
                                     next_seq + np.arange(n), np.full(n, offset)], 1))
                offset += v
            next_seq += n
    ends = np.cumsum(hist)
    residual = np.concatenate([order[take[v]:ends[v]] for v in np.flatnonzero(left)[::-1]]
                              or [np.empty(0, np.int64)])
    if len(residual):
        out.append(_greedy(residual, whole[residual] * window, rest[residual], window, next_seq))
    return np.concatenate(out)


def _greedy(docs, starts, lengths, window, next_seq) -> np.ndarray:
    """Fill windows one after the other, cutting at their ends; the open tail in powers of two."""
    ends = np.cumsum(lengths)
    total = int(ends[-1])
    tail = total % window
    bounds = list(range(0, total - tail + 1, window))
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    cuts = np.array(bounds)
    points = np.unique(np.concatenate([cuts, ends - lengths, ends]))
    lo, hi = points[:-1], points[1:]
    who = np.searchsorted(ends, lo, side="right")
    seq = np.searchsorted(cuts, lo, side="right") - 1
    return np.stack([docs[who], starts[who] + lo - (ends - lengths)[who], hi - lo,
                     next_seq + seq, lo - cuts[seq]], 1)


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                   window: int = 4096, end_id: int = 2, group_ids: int = 2_000_000,
                   max_pieces: int = 300_000) -> DataFrame:
    """Pieces of every document: ``doc_id, start, length, doc_tokens, sequence_id, offset``
    and the piece's ``ids`` (little-endian uint32).

    Null and empty texts are documents of one id (``end_id``).  Repeated rows and
    repeated or null ids are documents of their own.  An empty table gives no
    rows; other columns are ignored.  A group holds about ``group_ids`` ids (more
    only for one longer document), which bounds a task's memory.
    ``sequence_id`` is unique over all tasks.  A worker remembers ``max_pieces`` pieces of
    texts (about 250 bytes each), which saves encoding them again.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        encoder = worker_encoder(tokenizer, "drop", max_pieces)
        held: list = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, held, size
            keys = [k for part in held for k in part[0]]
            ids = np.concatenate([part[1] for part in held])
            lengths = np.concatenate([part[2] for part in held])
            held, size = [], 0
            rows = pack_group(lengths, window)
            first = np.cumsum(lengths) - lengths
            raw = ids.astype("<u4").tobytes()
            at = first[rows[:, 0]] + rows[:, 1]
            for lo in range(0, len(rows), 20_000):
                part, where = rows[lo:lo + 20_000], at[lo:lo + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[i] for i in part[:, 0]], pa.int64()), pa.array(part[:, 1]),
                    pa.array(part[:, 2]), pa.array(lengths[part[:, 0]]),
                    pa.array(base + part[:, 3]), pa.array(part[:, 4]),
                    pa.array([raw[4 * a:4 * (a + n)] for a, n in
                              zip(where.tolist(), part[:, 2].tolist(), strict=True)],
                             pa.binary())], names)
            base += int(rows[:, 3].max()) + 1

        for keys, texts in text_batches(batches, 500_000):
            ids, lengths = encoder.encode(texts, end_id)
            held.append((keys, ids, lengths))
            size += len(ids)
            if size >= group_ids:
                yield from flush()
        if held:
            yield from flush()

    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(run, PIECES)
