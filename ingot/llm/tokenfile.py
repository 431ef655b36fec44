"""Token files: documents as ids in ascending document order, range-coded.

A file table has one row per segment.  A segment holds whole documents (about
``segment_ids`` ids), carries their directory and its own independently coded,
checksummed blocks, and can be read by itself.  ``(part, segment)`` orders the
segments; parts are ranges of document ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW_CHARS, text_batches
from .rangecoder import decode_blocks, encode_blocks
from .tokens import worker_encoder

SEGMENTS = "part long, segment long, n_docs long, n_ids long, frame binary"
MAGIC = b"IDS1"


def encode_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block: int) -> bytes:
    """Frame of whole documents: header, directory (ids with nulls, lengths), blocks."""
    payloads, crcs = encode_blocks(ids, block)
    known = np.array([d is not None for d in doc_ids], bool)
    directory = zlib.compress(b"".join([
        known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.asarray(lengths).astype("<i8").tobytes(), crcs.astype("<u4").tobytes(),
        np.array([len(p) for p in payloads], "<u4").tobytes()]))
    head = MAGIC + struct.pack("<QQIII", len(doc_ids), len(ids), block, len(payloads),
                               len(directory))
    body = head + directory
    return b"".join([body, struct.pack("<I", zlib.crc32(body)), *payloads])


def decode_segment(frame: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids); raises ValueError if any checksum differs."""
    size = 4 + struct.calcsize("<QQIII")
    if frame[:4] != MAGIC:
        raise ValueError("not a token segment")
    n_docs, n_ids, block, n_blocks, n_dir = struct.unpack("<QQIII", frame[4:size])
    end = size + n_dir
    if struct.unpack("<I", frame[end:end + 4])[0] != zlib.crc32(frame[:end]):
        raise ValueError("checksum of the directory differs")
    raw, at = zlib.decompress(frame[size:end]), 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, n, at)
        at += out.nbytes
        return out

    known, keys, lengths = take("?", n_docs), take("<i8", n_docs), take("<i8", n_docs)
    crcs, sizes = take("<u4", n_blocks), take("<u4", n_blocks)
    ends = end + 4 + np.cumsum(sizes.astype(np.int64))
    payloads = [frame[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
    doc_ids = [k if ok else None for k, ok in zip(keys.tolist(), known.tolist(), strict=True)]
    return doc_ids, lengths, decode_blocks(payloads, n_ids, block, crcs)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id",
                 text: str = "text", end_id: int = 2, block: int = 2048,
                 segment_ids: int = 5_000_000, part_chars: int = 12_000_000) -> None:
    """Write every document's ids, ``end_id`` after each, to ``path``.

    Null and empty texts are documents of one id.  Null document ids come first;
    repeated rows stay, in any order among themselves.  An empty table writes no
    segment.  Other columns are ignored.  A text of any length is encoded whole, in the
    memory of one task.  The number of parts follows the total length of the texts and the
    number of rows, and rows that share an id are dealt out by a second, hashed key, so a
    task's memory does not grow with the table.
    """
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                      docs[text].cast("string").alias("text"))
    chars = own.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + ROW_CHARS)).first()[0] or 0
    parts = max(1, -(-chars // part_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, segment = TaskContext.get().partitionId(), 0
        encoder = worker_encoder(tokenizer, "lead")
        held: list = []

        def flush() -> pa.RecordBatch:
            nonlocal held, segment
            keys = [k for g in held for k in g[0]]
            lengths = np.concatenate([g[2] for g in held])
            ids = np.concatenate([g[1] for g in held])
            held = []
            frame = encode_segment(keys, lengths, ids, block)
            segment += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (part, segment - 1, len(keys), len(ids), frame)],
                ["part", "segment", "n_docs", "n_ids", "frame"])

        for keys, texts in text_batches(batches, 2_000_000):
            ids, lengths = encoder.encode(texts, end_id)
            held.append((keys, ids, lengths))
            if sum(len(g[1]) for g in held) >= segment_ids:
                yield flush()
        if held:
            yield flush()

    tie = F.xxhash64(F.monotonically_increasing_id())
    (own.withColumn("tie", tie).repartitionByRange(parts, "doc_id", "tie")
     .sortWithinPartitions("doc_id", "tie").drop("tie").mapInArrow(run, SEGMENTS).write.parquet(f"{path}/segments"))
    segment_starts(docs.sparkSession.read.schema(SEGMENTS).parquet(f"{path}/segments")
                   ).write.parquet(f"{path}/index")


def segment_starts(segments: DataFrame, group: int = 1024) -> DataFrame:
    """``part, segment, start``: ids in all segments before, by sums in two levels.

    Parts are grouped, so that no task takes all segments: one window inside each
    group, one over the groups' totals.
    """
    rows = segments.select("part", "segment", "n_ids", F.floor(F.col("part") / group)
                           .alias("grp"))
    inner = Window.partitionBy("grp").orderBy("part", "segment").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = rows.groupBy("grp").agg(F.sum("n_ids").alias("total"))
    outer = Window.partitionBy(F.lit(0)).orderBy("grp").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("grp", F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("base"))
    return (rows.withColumn("inside", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
            .join(offsets, "grp")
            .select("part", "segment", (F.col("base") + F.col("inside")).alias("start")))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian uint32) of a token file, decoded."""
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    # The index has three numbers per segment; Spark broadcasts it while its files are
    # below the broadcast threshold, and else shuffles the coded frames, not the ids.
    index = spark.read.schema("part long, segment long, start long").parquet(f"{path}/index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                keys, lengths, ids = decode_segment(frame)
                raw = ids.astype("<u4").tobytes()
                first = np.cumsum(lengths) - lengths
                for lo in range(0, len(keys), 5000):
                    n, at = lengths[lo:lo + 5000], first[lo:lo + 5000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[lo:lo + 5000], pa.int64()), pa.array(base + at),
                        pa.array(n), pa.array([raw[4 * a:4 * (a + k)] for a, k in zip(
                            at.tolist(), n.tolist(), strict=True)], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return segments.join(index, ["part", "segment"]).select("start", "frame").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
