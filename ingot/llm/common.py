"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path, remove_path


_SHIPPED: set[str] = set()
_WRITTEN: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, so that
    their Python workers can import them wherever the driver found them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation above this point.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return written_at(df, path)


def remove_written(spark: SparkSession) -> int:
    """Remove the intermediate tables that operators wrote in this application so far; how many.

    Results that were not stored yet can't be read any more."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def written_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a Parquet table at ``path``, read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, group: str, order: list[str], path: str,
             within: list[str] | None = None) -> DataFrame:
    """``rows`` with ``place``, their number within ``group`` (from 0) in the order of ``order``,
    and ``total``, the group's size.

    ``order`` sorts all rows, nulls first, and keeps each group together.  One range shuffle; a
    partition's rows are numbered as they lie, and a group's rows in earlier partitions are
    added, so a group of any size is spread over tasks.  ``within`` orders rows that tie on
    ``order``, and does not reach the driver as the sampled ``order`` does.  ``path`` holds
    the sorted rows.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    inside = keys + [F.col(c).asc_nulls_first() for c in within or []]
    laid = written_at(rows.repartitionByRange(*keys).sortWithinPartitions(*inside).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("line")),
        path)
    counts = laid.groupBy(group, "part").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy(group)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "part", "first", F.sum("n").over(own).alias("total"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return laid.join(counts, [group, "part"]).select(
        *rows.columns, (F.col("base") + F.col("line") - F.col("first")).alias("place"), "total")


ROW_CHARS = 64
ROWS = 500          # rows of which a task holds Python objects at a time, besides a group's


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``ROWS`` rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def text_batches(batches: Iterator[pa.RecordBatch], max_chars: int = 4_000_000,
                 ) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) groups of about ``max_chars`` characters; null texts read as empty.

    The input's first column is the document id and its second the text.  A row counts
    ``ROW_CHARS`` besides its text, so empty texts fill a group too.
    """
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in small_batches(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                strict=True):
            ids.append(doc_id)
            texts.append(text or "")
            size += len(texts[-1]) + ROW_CHARS
            if size >= max_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def remainder(doc_id: str, modulus: int):
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def word_terms(text, pattern: str = r"[^\p{L}\p{N}]+"):
    """Lower-cased words of a text column (null: no words), by a separator pattern."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), pattern), lambda w: w != "")
