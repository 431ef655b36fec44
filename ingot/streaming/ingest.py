"""Structured Streaming: message sources, the bronze sink, stream dedupe.

The production source is a Kafka topic.  The connector jar is not on this
machine, so every stream here can also read the same ``(key, value)`` messages
from a directory of Parquet files; the transforms downstream are identical.
Streams write with a checkpoint below the shared folder, so a restarted query
neither loses nor repeats a micro-batch: Spark's file sink by its commit log, streams of
several outputs by directories per micro-batch and the ledger (``ledger.py``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..functions.columns import message_key
from ..operators.bronze import bronze_ingest, parse_envelope, quarantined, to_bronze
from ..session import fresh_path, list_names, path_exists, remove_path
from .ledger import Batch, enter

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
MESSAGE_SCHEMA = StructType([StructField("key", BinaryType(), True),
                             StructField("value", BinaryType(), True)])


def kafka_options(bootstrap: str, topic: str, starting: str = "earliest",
                  fail_on_data_loss: bool = False, max_offsets: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of the Kafka source.

    ``minPartitions`` splits topic partitions into more Spark tasks when the
    topic has fewer partitions than the cluster has cores; ``maxOffsetsPerTrigger``
    bounds one micro-batch (the reference's sleeps, re-aimed as a rate cap).
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_messages(spark: SparkSession, source: str, location: str,
                  options: dict | None = None, max_files: int | None = None) -> DataFrame:
    """A streaming DataFrame of messages.

    ``source='kafka'``: ``location`` is ignored and ``options`` come from
    :func:`kafka_options`.  ``source='files'``: ``location`` is a directory of
    Parquet files holding ``(key, value)`` rows; ``max_files`` caps a batch.
    """
    if source == "kafka":
        return spark.readStream.format("kafka").options(**(options or {})).load()
    # Recursive: a topic that a hop writes has one directory per micro-batch.
    reader = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.options(**(options or {})).parquet(location)


def land_messages(messages: DataFrame, location: str, files: int = 4,
                  mode: str = "append") -> None:
    """Write ``(key, value)`` messages as Parquet files a file stream can read.

    Rows are range-partitioned on the key so each file is one key range; keys are written
    as a topic holds them, as bytes of their text.
    """
    spread = messages.repartitionByRange(files, "key")
    spread.withColumn("key", message_key("key")).write.mode(mode).parquet(location)


def run_to_table(stream: DataFrame, path: str, checkpoint: str,
                 partition_cols=("partition_date",), available_now: bool = True,
                 processing_time: str | None = None, query_name: str | None = None,
                 timeout_s: float | None = None, files_per_batch: int | None = None):
    """Append a stream to a partitioned Parquet table with a checkpoint.

    ``available_now`` drains what is there in (possibly several) bounded
    micro-batches and stops; otherwise the query runs on ``processing_time``
    until stopped.  ``files_per_batch`` deals each micro-batch's result out to that
    many files, after the parse, so a frequent trigger does not litter the table
    with small files and the parse keeps its tasks.  Returns the
    ``StreamingQuery``; a drain that does not end within ``timeout_s`` is stopped
    and raises ``TimeoutError`` (what it committed stays; a restart goes on).
    """
    if files_per_batch:
        stream = stream.repartition(files_per_batch)
    w = (stream.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).option("path", path))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return _finish(w.start(), available_now, timeout_s)


def _finish(q, available_now: bool, timeout_s: float | None):
    """Wait for a draining query to end; its errors and a timeout are raised."""
    if available_now:
        ended = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
        if q.exception() is not None:
            raise q.exception()
        if not ended:
            q.stop()
            raise TimeoutError(f"the stream did not drain within {timeout_s} s")
    return q


@dataclass(frozen=True)
class Output:
    """One of several results of a stream: which rows of a micro-batch, and where they go.

    ``fmt`` is "table" (Parquet, partitioned by ``by`` and micro-batch),
    "files" (``(key, value)`` messages as Parquet) or "kafka" (``path`` is the
    topic, ``options`` the connection).  ``extend`` adds to the micro-batch's rows what only
    this output takes, such as a document: it is looked up as the output is written, so it
    is not kept beside it.  With ``rows_per_file`` a batch's files follow its rows."""

    select: Callable[[Batch], DataFrame]
    path: str
    fmt: str = "table"
    options: dict = field(default_factory=dict)
    by: str = "partition_date"
    extend: Callable[[DataFrame], DataFrame] | None = None
    rows_per_file: int | None = None


def check_messages(rows: DataFrame) -> DataFrame:
    """``rows`` if a topic takes them: keys and values are text or bytes."""
    types = dict(rows.dtypes)
    bad = {c: t for c, t in types.items() if c not in ("key", "value") or t not in (
        "string", "binary")}
    if bad or "value" not in types:
        raise ValueError(f"a topic takes key and value as string or binary, not {types}")
    return rows


DEALT_ROWS = 400_000        # of a micro-batch that are shuffled to be written in a few files


def _in_files(rows: DataFrame, held: DataFrame, files: int, rows_per_file: int | None) -> DataFrame:
    """``rows`` dealt out to ``files`` files, or to more where one would hold over
    ``rows_per_file`` of the ``held`` rows.  Wide rows of a large batch are not shuffled for that:
    each task then writes the rows it has."""
    if not rows_per_file:
        return rows.repartition(files)
    n = held.count()
    files = max(files, -(-n // rows_per_file))
    return rows.coalesce(files) if n > DEALT_ROWS else rows.repartition(files)


def run_split(stream: DataFrame, outputs: list[Output], checkpoint: str,
              available_now: bool = True, processing_time: str | None = None,
              timeout_s: float | None = None, files_per_batch: int | None = None,
              prepare: Callable[[Batch], DataFrame] | None = None, newest: str | None = None):
    """Write each micro-batch to several outputs in one pass over it.

    The micro-batch is computed once and kept on the executors' disks while its
    outputs are written (a lost part is recomputed from the source).  ``prepare``
    turns it into what the outputs select from, once as well.  Every output of a batch goes
    to a directory named by the query and the batch, replaced as a whole, under the load
    date that the ledger fixed when the batch first ran; so a batch that is repeated
    after a failure, be it on another day, gives the same rows once.  Kafka outputs are
    repeated at least once, as Kafka's sink is.  ``newest`` names an event time whose
    newest value so far each batch is told.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        held = [batch.persist(StorageLevel.DISK_ONLY)]
        try:
            now = Batch(batch, f"{query}-{batch_id:08d}", *enter(
                spark, checkpoint, query, batch_id, lambda: newest and _newest(batch, newest)))
            if prepare:
                held.append(prepare(now).persist(StorageLevel.DISK_ONLY))
                now = replace(now, rows=held[-1])
            for o in outputs:
                rows = o.select(replace(now, rows=o.extend(now.rows)) if o.extend else now)
                if files_per_batch:
                    rows = _in_files(rows, now.rows, files_per_batch, o.rows_per_file)
                if o.fmt == "kafka":
                    check_messages(rows).write.format("kafka").options(**o.options).option(
                        "topic", o.path).save()
                elif o.fmt == "files":
                    rows.write.mode("overwrite").option("compression", "zstd").parquet(
                        f"{o.path}/batch={now.tag}")
                else:
                    (rows.withColumn("batch", F.lit(now.tag)).write.mode("overwrite")
                     .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
                     .options(**o.options)
                     .partitionBy(o.by, "batch").parquet(o.path))
        finally:
            for df in held:
                df.unpersist()
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return _finish(w.start(), available_now, timeout_s)


def _newest(batch: DataFrame, column: str) -> dt.datetime | None:
    micros = batch.agg(F.unix_micros(F.max(column))).first()[0]
    return None if micros is None else EPOCH + dt.timedelta(microseconds=micros)


def _bad_texts(envelopes: DataFrame) -> DataFrame:
    """Parsed messages with the text of bad ones only: a good one's document is a column of
    its own, and the text would be kept beside it while the batch is written."""
    return envelopes.withColumn("_raw", F.when(F.col("_bad"), F.col("_raw")))


def ingest_with_quarantine(messages: DataFrame, sink: str, quarantine: str, checkpoint: str,
                           partition_date=None, **options):
    """L1 + T6: messages -> bronze table, and what does not parse -> quarantine table, in one
    pass.  Every message lands in exactly one of the two."""
    keep = ("key",) if "key" in messages.columns else ()

    return run_split(_bad_texts(parse_envelope(messages, keep=keep)), [
        Output(lambda b: to_bronze(b.rows, _day(b, partition_date)), sink),
        Output(lambda b: quarantined(b.rows, _day(b, partition_date), keep), quarantine)],
        checkpoint, **options)


def _day(b: Batch, given=None):
    """The load date of a batch's rows: the given one, else the batch's.  A column that has
    none for a row (a message that does not parse) gives way to the batch's date too."""
    if given is None:
        return b.day
    return F.coalesce(given, F.lit(b.day)) if isinstance(given, Column) else given


HOUR = "yyyy-MM-dd-HH"
JUDGED_ROWS = 500_000       # of a micro-batch that a task looks through for repeats


def keys_path(sink: str) -> str:
    """Where the index of a deduplicated table's landed keys lies."""
    return f"{sink.rstrip('/')}_keys"


def landed_keys(spark: SparkSession, sink: str, since: dt.datetime, batch: str = "") -> DataFrame:
    """``key, event_time`` of what landed since a time, from the index: only the hours since
    are read, and nothing of the table itself.  ``batch`` is left out (a repeated batch)."""
    index = spark.read.schema(
        "key binary, event_time timestamp, hour string, batch string").parquet(keys_path(sink))
    return index.where((F.col("hour") >= f"{since:%Y-%m-%d-%H}") & (F.col("event_time") >= F.lit(since))
                       & (F.col("batch") != batch)).select("key", "event_time")


def forget_keys(spark: SparkSession, sink: str, since: dt.datetime) -> None:
    """Drop the index's hours before a time, which no later batch asks for."""
    root = keys_path(sink)
    for name in list_names(spark, root):
        if name.startswith("hour=") and name[5:] < f"{since:%Y-%m-%d-%H}":
            remove_path(spark, f"{root}/{name}")


def ingest_deduplicated(messages: DataFrame, sink: str, quarantine: str, late: str,
                        checkpoint: str, delay_s: int, partition_date=None, **options):
    """L1 + T6 + T8: as ``ingest_with_quarantine``, each key landing once, nothing dropped as late.

    A row whose event time is within ``delay_s`` seconds of the newest one seen by
    earlier micro-batches is a repeat if its key is in this batch already or landed
    in that span.  Landed keys are looked up in an index of their own (``landed_keys``):
    key and event time by hour, with Bloom filters on the key, cut off at the delay, so a
    batch costs the same however old the table is.  An older row, or one without an
    event time, can't be told from a first delivery, so it goes to the ``late`` table.
    A message without a key is no repeat of another one: it lands as it is.
    Landed + repeats + late + quarantined = sent.
    """
    rows = _bad_texts(parse_envelope(messages, keep=("key",))).withColumn("event_time", event_time())

    def since(b: Batch) -> dt.datetime | None:
        return b.before and b.before - dt.timedelta(seconds=delay_s)

    def judged(b: Batch) -> DataFrame:
        """The batch without its repeats; ``_late`` marks what can't be judged."""
        limit = since(b)
        old = F.lit(False) if limit is None else F.col("event_time") < F.lit(limit)
        marked = b.rows.withColumn("_late", ~F.col("_bad") & (F.col("event_time").isNull() | old))
        asked = ~F.col("_bad") & ~F.col("_late") & F.col("key").isNotNull()
        spark = b.rows.sparkSession
        # Dealt out first, to partitions of a bounded number of rows: whole rows are sorted to
        # drop the repeats, and would be, too, in every map task, however large its split.
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                    -(-b.rows.count() // JUDGED_ROWS))
        keyed = marked.where(asked).repartition(parts, "key").dropDuplicates(["key"])
        if limit is not None and path_exists(spark, keys_path(sink)):
            keyed = keyed.join(landed_keys(spark, sink, limit, b.tag).select("key"), "key",
                               "left_anti").select(*marked.columns)
        return keyed.unionByName(marked.where(~asked))

    def bronze(b: Batch, which: Column) -> DataFrame:
        return to_bronze(b.rows.where(which), _day(b, partition_date), ("key", "event_time"))

    def keys(b: Batch) -> DataFrame:
        if (limit := since(b)) is not None:
            forget_keys(b.rows.sparkSession, sink, limit)
        # No later batch asks for what is older than the delay already.
        asked = ~F.col("_bad") & ~F.col("_late") & F.col("key").isNotNull()
        if b.newest is not None:
            asked &= F.col("event_time") >= F.lit(b.newest - dt.timedelta(seconds=delay_s))
        return b.rows.where(asked).select(
            "key", "event_time", F.date_format("event_time", HOUR).alias("hour"))
    bloom = {"parquet.bloom.filter.enabled#key": "true"}
    return run_split(rows, [
        Output(lambda b: bronze(b, ~F.col("_late")), sink),
        Output(lambda b: bronze(b, F.col("_late")), late),
        Output(lambda b: quarantined(b.rows, _day(b, partition_date), ("key",)), quarantine),
        Output(keys, keys_path(sink), options=bloom, by="hour")],
        checkpoint, prepare=judged, newest="event_time", **options)


def bronze_stream(spark: SparkSession, source: str, location: str, sink: str,
                  checkpoint: str | None = None, partition_date=None,
                  options: dict | None = None, max_files: int | None = None,
                  available_now: bool = True):
    """L1: topic -> bronze table, appended by Spark's file sink with its commit log, which
    hides half-written batches from readers of the root."""
    msgs = read_messages(spark, source, location, options, max_files)
    bronze = bronze_ingest(msgs, partition_date)
    return run_to_table(bronze, sink, checkpoint or fresh_path(spark, "ckpt-bronze"),
                        available_now=available_now)


def event_time(text: str = "timestamp_summoner") -> Column:
    """Event time for watermarks: the stage text as a zoned ``timestamp``
    (watermarks reject ``timestamp_ntz``); null for malformed text."""
    return F.col(text).try_cast("timestamp")


def dedupe_stream(bronze: DataFrame, key: str, delay: str,
                  time_col: str = "event_time") -> DataFrame:
    """Drop repeated messages within the watermark delay.

    ``dropDuplicatesWithinWatermark`` keeps one row per key and holds the key
    in state only until the watermark passes its event time + ``delay``, so
    state stays bounded on an unbounded stream.  A copy arriving later than
    the delay is older than the watermark and dropped as late, which for a
    repeat is the wanted outcome; ``delay`` must cover how late a first
    delivery can be.
    """
    return bronze.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])
