"""Sinks: date-partitioned Parquet tables and message topics."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import message_key, to_message
from ..session import fresh_path, hadoop_path, path_exists, remove_path, write_text
from .tables import as_date


def overwrite_partitions(df: DataFrame, path: str, partition_cols=("partition_date",),
                         spread_col: str | None = None) -> None:
    """Replace only the dates present in ``df`` (S5, quirk Q5).

    ``partitionOverwriteMode=dynamic`` is set on the write itself, so other
    dates survive whatever the session default is; a rerun of one date gives
    the same table.  ``spread_col`` (e.g. ``match_id``) hash-clusters rows
    before the write so each task writes a few large files per date instead
    of every task writing a small file into every date.
    """
    if spread_col:
        df = df.repartition(*partition_cols, spread_col)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy(*partition_cols).parquet(path))


def as_messages(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows -> ``(key, value)`` JSON messages, the shape a topic sink takes."""
    cols = [c for c in df.columns if c != key_col]
    out = [to_message(*cols).cast("binary").alias("value")]
    if key_col:
        out.insert(0, message_key(key_col).alias("key"))
    return df.select(*out)


def write_messages(df: DataFrame, fmt: str, target: str, options: dict | None = None) -> None:
    """Publish messages in batch: ``fmt='kafka'`` (target = topic) or a file format."""
    w = df.write.options(**(options or {}))
    if fmt == "kafka":
        w.format("kafka").option("topic", target).save()
    else:
        w.mode("append").format(fmt).save(target)


def publish_bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None,
                     gather: bool = True) -> DataFrame:
    """Materialise a lookup table once, bucketed and sorted on its join key.

    The table is external, stored below the shared folder, and registered in
    the session catalog under a fresh name.  A stream-static join against it
    shuffles only the stream side of each micro-batch: the lookup side is read
    with its bucket partitioning instead of being re-scanned and re-shuffled
    (or recomputed, when it is derived) on every trigger.  ``buckets``
    defaults to ``spark.sql.shuffle.partitions`` so the exchange on the stream
    side lines up with the buckets.  Without ``gather`` rows are not shuffled to their bucket's
    one file: every task writes its rows into files of its own, one per bucket.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"ingot_{name}_{uuid.uuid4().hex[:10]}"
    write_bucketed(df, key, table, fresh_path(spark, f"lookup-{name}"), n, gather)
    return spark.table(table)


def write_bucketed(df: DataFrame, key: str, table: str, path: str, buckets: int,
                   gather: bool = True) -> None:
    """(Re)write ``table`` at ``path`` in ``buckets`` buckets of ``key``.

    Rows are first hash-partitioned into as many partitions as buckets, so each
    bucket is one file whatever the number of tasks that read the source.  Rows as wide as
    documents take more room in that shuffle than in the table: without ``gather`` they stay
    in their tasks, and a bucket is one file of each."""
    if gather:
        df = df.repartition(buckets, key)
    (df.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))


ROWS_PER_BUCKET_FILE = 500


def bucket_layout(spark, n_rows: int, rows_per_bucket: int) -> tuple[int, bool]:
    """(buckets, whether to gather them) for so many rows.

    A bucket holds at most ``rows_per_bucket``, about what a task can sort; there are as many as
    shuffle partitions where their files stay large enough.  Rows are not gathered as long as
    as many tasks as buckets leave ``ROWS_PER_BUCKET_FILE`` rows in a file, so the number of
    files grows no faster than the rows: a larger table goes through the shuffle."""
    need, files = max(1, -(-n_rows // rows_per_bucket)), n_rows // ROWS_PER_BUCKET_FILE
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(need, min(parts, math.isqrt(files))), need > 1 and need * need > files


@contextmanager
def clustered(df: DataFrame, key: str, name: str, buckets: int, gather: bool) -> Iterator[DataFrame]:
    """``df`` while it is in use, written once in ``buckets`` buckets of ``key``.

    What groups or joins it by ``key`` (and more columns) adds no exchange.  Parquet takes a
    third of the room that the same rows take in a shuffle, a reader takes its own columns, and
    the files go when the job is through with them."""
    spark = df.sparkSession
    table, path = f"ingot_{name}_{uuid.uuid4().hex[:10]}", fresh_path(spark, f"clustered-{name}")
    try:
        write_bucketed(df, key, table, path, buckets, gather)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        remove_path(spark, path)


VERSION = "__v"


def publish_version(df: DataFrame, key: str, name: str, path: str, buckets: int,
                    keep: int = 2) -> str:
    """Write a lookup as a new bucketed table and point the view ``name`` at it; its name.

    The view is switched in one step once the table is whole, so a reader finds the old
    version or the new one.  Whoever resolved the old one goes on reading it: the ``keep``
    newest versions stay, older ones are dropped with their files.
    """
    spark = df.sparkSession
    old = sorted(t.name for t in spark.catalog.listTables(pattern=f"{name}{VERSION}*"))
    number = int(old[-1].removeprefix(f"{name}{VERSION}")) + 1 if old else 1
    table = f"{name}{VERSION}{number:012d}"
    root = f"{path.rstrip('/')}/{VERSION.strip('_')}{number:012d}"
    write_bucketed(df, key, table, root, buckets)
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM `{table}`")
    for gone in [*old, table][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS `{gone}`")
        remove_path(spark, f"{path.rstrip('/')}/{gone.removeprefix(name).strip('_')}")
    return table


def drop_partition(spark, path: str, partition_date, column: str = "partition_date") -> None:
    """Remove one date's directory from a date-partitioned table (if present)."""
    remove_path(spark, f"{path.rstrip('/')}/{column}={partition_date}")


def purge_before(spark, path: str, cutoff, column: str = "partition_date") -> list[str]:
    """Drop the dates before ``cutoff`` from a date-partitioned table (R3); the dropped dates.

    Only directories are listed and removed; no row is read or rewritten.  A missing
    root is an error, so a mistyped path cannot pass for an empty table; so is a table that
    Spark's streaming file sink wrote, whose commit log would go on naming the files."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        raise FileNotFoundError(path)
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} has a streaming commit log, which names the files to be dropped")
    found = [s.getPath().getName().partition("=") for s in fs.listStatus(root)]
    old = sorted(v for k, _, v in found if k == column and v < str(as_date(cutoff)))
    for v in old:
        drop_partition(spark, path, v, column)
    return old


PUBLISHED = "_published"


def is_published(spark, path: str, partition_date) -> bool:
    """Whether a table's date was published whole; a table without marks counts as published
    (it is written by other means than ``replace_dates``)."""
    marks = f"{path.rstrip('/')}/{PUBLISHED}"
    return not path_exists(spark, marks) or path_exists(spark, f"{marks}/{as_date(partition_date)}")


def replace_dates(outputs: dict[str, DataFrame], partition_date) -> None:
    """Make one date of several tables hold exactly the given rows, all of them together.

    Every table's rows are first written to a folder beside its dates.  Only when all are
    there are the date's marks taken away, the new directories put in the old ones' place
    by renaming, and the marks set again.  A failure before that leaves the old date whole;
    one in between leaves it without marks, and a run of the job mends it.  A table whose
    new rows are none loses the date.
    """
    spark = next(iter(outputs.values())).sparkSession
    date, run = as_date(partition_date), uuid.uuid4().hex[:12]
    staged = {path: f"{path.rstrip('/')}/_staged-{run}" for path in outputs}
    name = f"partition_date={date}"
    try:
        for path, df in outputs.items():
            df.write.option("compression", "zstd").partitionBy("partition_date").parquet(staged[path])
        for path in outputs:
            remove_path(spark, f"{path.rstrip('/')}/{PUBLISHED}/{date}")
            fs, marks = hadoop_path(spark, f"{path.rstrip('/')}/{PUBLISHED}")
            fs.mkdirs(marks)
        for path in outputs:
            drop_partition(spark, path, date)
            if path_exists(spark, f"{staged[path]}/{name}"):
                fs, new = hadoop_path(spark, f"{staged[path]}/{name}")
                if not fs.rename(new, hadoop_path(spark, f"{path.rstrip('/')}/{name}")[1]):
                    raise OSError(f"can't put {name} of {path} in place")
        for path in outputs:
            write_text(spark, f"{path.rstrip('/')}/{PUBLISHED}/{date}", run)
    finally:
        for folder in staged.values():
            remove_path(spark, folder)


def replace_date(df: DataFrame, path: str, partition_date,
                 probe: DataFrame | None = None) -> None:
    """Make ``path``'s partition for ``partition_date`` hold exactly ``df``.

    Dynamic overwrite replaces the dates present in ``df``; a date whose new
    content is empty would otherwise keep stale rows from an earlier run, so
    it is removed instead.  Emptiness is checked on ``probe`` when given (an
    input that is empty exactly when ``df`` is, e.g. the rows an aggregate
    reads), else on ``df``; ``isEmpty`` runs a one-row job.
    """
    if (probe if probe is not None else df).isEmpty():
        fs, root = hadoop_path(df.sparkSession, path)
        fs.mkdirs(root)        # an empty table exists, so readers can tell it from a wrong path
        drop_partition(df.sparkSession, path, partition_date)
    else:
        overwrite_partitions(df, path)
