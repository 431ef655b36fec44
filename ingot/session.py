"""Session construction and the shared working folder.

A cluster names one shared folder in ``spark.checkpoint.dir``; every written
intermediate (landed fixture tables, stream checkpoints, partitioned test
tables) goes below it.  Only when nothing is configured (local tests) do we
create one of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  UTC is pinned because stage timestamps
# are naive UTC text.  AQE re-plans joins (broadcast only when the measured
# side is under the threshold), coalesces small shuffle partitions and splits
# skewed ones.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Suggested settings for a large cluster (about 1000 executors, tens of TB a
# day).  Not applied by ``build_session``; pass them as ``extra`` or put them
# in the cluster's defaults.
#  - Many shuffle partitions, which AQE coalesces to ~128 MB each at run time:
#    the key dedupe of a large day cannot spill into a few huge tasks.
#  - 256 MB scan splits: bronze documents are ~2 KB each, so a split is about
#    a hundred thousand documents, which parses in seconds and fits in memory.
#  - The skew join splits a partition larger than 5x the median and over
#    256 MB (a hot match or player in a batch join).
#  - The broadcast threshold stays at Spark's default; no join carries a hint, so
#    broadcasting a growing lookup table is never forced.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ingot", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_session(spark: SparkSession) -> None:
    """Apply the runtime settings the pipeline's semantics depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


_OWN_ROOTS: dict[str, str] = {}


def _configured(spark: SparkSession) -> str | None:
    """The folder named by the setting, or by ``setCheckpointDir`` on the context."""
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or (
        jdir.get() if jdir.isDefined() else None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session.  Only when it is unset on a local master (tests, a
    laptop) is a folder of our own created; it is remembered per application
    (the setting itself cannot be changed at runtime) and also registered as
    the context's checkpoint directory, so ``DataFrame.checkpoint()`` writes
    there too.  On a cluster the driver's temporary folder is not the
    executors', so an unset folder is an error there.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    root = _configured(spark) or _OWN_ROOTS.get(sc.applicationId)
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="ingot-shared-")
        _OWN_ROOTS[sc.applicationId] = root
    if not jdir.isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a location, through Spark's own file system layer."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a location a job wrote for itself (or one date of a table), if present."""
    fs, p = hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, then renamed.  A file that is
    there already stays as it is."""
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    _, draft = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if it does not exist."""
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


__all__ = ["build_session", "pin_session", "shared_root", "fresh_path", "hadoop_path",
           "path_exists", "remove_path", "write_text", "read_text", "list_names", "CORE_CONF", "CLUSTER_CONF"]

