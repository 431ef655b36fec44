"""Batch sources: the driver's Parquet tables and date-partitioned layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.schemas import METRIC_SCHEMA, SNAPSHOT_SCHEMA
from ..session import path_exists
from .compaction import live_paths

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Projections and filters applied later reach the
    Parquet scan (``ReadSchema`` / ``PushedFilters``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def read_layer(spark: SparkSession, base: str, partition_date=None,
               date_column: str = "partition_date") -> DataFrame:
    """Read a table partitioned by date from its root.

    Reading the root and filtering keeps ``partition_date`` as a column,
    prunes directories (``PartitionFilters``) and, for a table of Spark's streaming
    file sink (``run_to_table``), honours the sink's commit log so half-written batches
    are never seen.  The tables of ``run_split`` have no such log: a micro-batch's
    directory appears when its write is committed.  A table that was compacted is
    read by its live directories.  A leaf path or a ``*/*.parquet`` glob would lose all
    of this.
    """
    live = live_paths(spark, base, None if partition_date is None else as_date(partition_date))
    if live:
        df = spark.read.option("basePath", base).parquet(*live)
    else:
        df = spark.read.parquet(base)
    if partition_date is not None:
        df = df.where(F.col(date_column) == F.lit(as_date(partition_date)))
    return df


def read_layer_if_present(spark: SparkSession, base: str, partition_date=None,
                          date_column: str = "partition_date") -> DataFrame | None:
    """``read_layer``, or ``None`` when the table exists but has no data files yet (a
    layer whose every run so far was empty).  A missing root is an error."""
    from pyspark.errors import AnalysisException
    try:
        return read_layer(spark, base, partition_date, date_column)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND" or not path_exists(spark, base):
            raise FileNotFoundError(base) from e
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_snapshots(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed leaderboard snapshots (JSON files, one object with ``entries[]`` each): ``entries``.

    ``keep`` names further string fields of the objects, or partition columns."""
    known = {f.name for f in SNAPSHOT_SCHEMA.fields}
    extra = [StructField(k, StringType()) for k in keep if k not in known]
    return spark.read.schema(StructType([*extra, *SNAPSHOT_SCHEMA.fields])).json(path)


def read_samples(spark: SparkSession, path: str, start=None, end=None,
                 after_start: bool = False) -> DataFrame:
    """A landed metric table ``(metric, labels, ts, value)``, partitioned by ``day`` if it is.

    ``start`` (exclusive with ``after_start``) and ``end`` (exclusive) are timestamps and
    reach the scan; on a table partitioned by day whole directories are skipped."""
    df = spark.read.schema(StructType([*METRIC_SCHEMA.fields, StructField("day", DateType())])
                           ).parquet(path)
    if start is not None:
        late = F.col("ts") > F.lit(start) if after_start else F.col("ts") >= F.lit(start)
        df = df.where(late & (F.col("day").isNull() | (F.col("day") >= F.to_date(F.lit(start)))))
    if end is not None:
        df = df.where((F.col("ts") < F.lit(end))
                      & (F.col("day").isNull() | (F.col("day") <= F.to_date(F.lit(end)))))
    return df.select(*METRIC_SCHEMA.names)
