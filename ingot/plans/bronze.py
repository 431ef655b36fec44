"""Bronze layer and table mechanics: ingest (batch and stream), quarantine,
stream dedupe, JSON round trip, partition scan / overwrite / retention.

Inputs are the driver's ``events`` rows published as ``matchs`` messages
(``ingot.sources.fixtures.envelope_messages``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import oracle_layers as O
from ..functions.columns import parse_json
from ..functions.schemas import BRONZE_COLUMNS
from ..operators.bronze import bronze_ingest, parse_envelope, quarantined
from ..registry import query
from ..session import fresh_path, pin_session
from ..sources import fixtures as X
from ..sources.sinks import as_messages, overwrite_partitions, purge_before
from ..sources.tables import read_layer, read_table
from ..streaming import ingest as S

RERUN_DATES = ("2024-01-10", "2024-01-12")   # partition_overwrite: dates rewritten
SCAN_DATE = "2024-01-15"                      # partition_scan: the date read
RETENTION_CUTOFF = "2024-01-20"               # retention_keep: first date kept
DEDUPE_DELAY = "2 hours"                      # stream_dedupe watermark delay
DEDUPE_DELAY_S = 86_400                       # stream_dedupe_late: a day
REPLAY_EVERY = 5                              # stream_dedupe: keys re-sent after restart


def _number():
    """A message's key, as the fixture numbers it."""
    return F.col("key").cast("string").cast("long").alias("key")


@query("bronze_ingest", O.BRONZE)
def q_bronze_ingest(spark: SparkSession, sf_dir: str):
    """L1 in batch: messages -> bronze rows of one load date."""
    pin_session(spark)
    return bronze_ingest(X.envelope_messages(spark, sf_dir), X.INGEST_DATE)


@query("quarantine", O.QUARANTINE)
def q_quarantine(spark: SparkSession, sf_dir: str):
    """Garbage envelopes (every tenth message cut short) go to quarantine with
    their raw text; the rest of the batch still lands (T6, Q7, Q14)."""
    pin_session(spark)
    env = parse_envelope(X.envelope_messages(spark, sf_dir, corrupt=True), keep=("key",))
    return quarantined(env, X.INGEST_DATE, keep=("key",))


@query("bronze_ingest_stream", O.BRONZE)
def q_bronze_ingest_stream(spark: SparkSession, sf_dir: str):
    """L1 as a stream: message files -> bronze table in several micro-batches
    (one file per trigger), then the table is read back from its root so only
    committed batches are seen.  Equal to ``bronze_ingest``."""
    pin_session(spark)
    topic, sink = fresh_path(spark, "topic-matchs"), fresh_path(spark, "bronze-stream")
    S.land_messages(X.envelope_messages(spark, sf_dir), topic, files=4)
    S.bronze_stream(spark, "files", topic, sink, fresh_path(spark, "ckpt-bronze"),
                    partition_date=X.INGEST_DATE, max_files=1)
    return spark.read.parquet(sink).select(*BRONZE_COLUMNS)


@query("quarantine_stream", O.QUARANTINE_STREAM)
def q_quarantine_stream(spark: SparkSession, sf_dir: str):
    """The ingest job on messages of which some are cut short, null, blank or without a
    known field, and some sent twice: every message lands once, in bronze or in
    the quarantine."""
    pin_session(spark)
    topic, sink, bad = (fresh_path(spark, n) for n in ("topic-odd", "bronze-odd", "bad-odd"))
    S.land_messages(X.odd_messages(spark, sf_dir), topic, files=4)
    S.ingest_with_quarantine(S.read_messages(spark, "files", topic, max_files=2), sink, bad,
                             fresh_path(spark, "ckpt-odd"), X.INGEST_DATE)
    nothing = F.lit(None).cast("string")
    return spark.read.parquet(sink).select(
        F.lit("bronze").alias("landed"), F.lit(None).cast("long").alias("key"),
        *BRONZE_COLUMNS[:-1], nothing.alias("raw_message")).unionByName(
        spark.read.parquet(bad).select(
            F.lit("quarantine").alias("landed"), _number(),
            *[nothing.alias(c) for c in BRONZE_COLUMNS[:-1]], "raw_message"))


@query("stream_dedupe", O.BRONZE_KEYED)
def q_stream_dedupe(spark: SparkSession, sf_dir: str):
    """Every third message is sent twice in the first run; after a restart
    on the same checkpoint every fifth is sent again.  Each key lands once."""
    pin_session(spark)
    topic, sink = fresh_path(spark, "topic-dup"), fresh_path(spark, "bronze-dedupe")
    ckpt = fresh_path(spark, "ckpt-dedupe")
    msgs = X.envelope_messages(spark, sf_dir)

    def run():
        env = parse_envelope(S.read_messages(spark, "files", topic), keep=("key",))
        rows = (env.where(~F.col("_bad"))
                .withColumn("event_time", S.event_time())
                .withColumn("partition_date", F.lit(X.as_date(X.INGEST_DATE))))
        out = S.dedupe_stream(rows, "key", DEDUPE_DELAY).select("key", *BRONZE_COLUMNS)
        S.run_to_table(out, sink, ckpt)

    S.land_messages(X.duplicated_messages(msgs), topic, files=4)
    run()
    S.land_messages(msgs.where(F.col("key") % REPLAY_EVERY == 0), topic, files=2)
    run()
    return spark.read.parquet(sink).select(_number(), *BRONZE_COLUMNS)


@query("stream_dedupe_late", O.BRONZE_LATE)
def q_stream_dedupe_late(spark: SparkSession, sf_dir: str):
    """T8 as the ingest job runs it: every third message is sent twice, and after a
    restart every fifth again.  Repeats within the delay are recognised by their
    landed key; older ones are kept in the late table.  Returns both tables."""
    pin_session(spark)
    topic, sink, late = (fresh_path(spark, n) for n in ("topic-late", "bronze-once", "bronze-late"))
    ckpt, bad = fresh_path(spark, "ckpt-late"), fresh_path(spark, "bad-late")
    msgs = X.envelope_messages(spark, sf_dir)

    def run():
        S.ingest_deduplicated(S.read_messages(spark, "files", topic), sink, bad, late, ckpt,
                              DEDUPE_DELAY_S, X.INGEST_DATE)
    S.land_messages(X.duplicated_messages(msgs), topic, files=4)
    run()
    S.land_messages(msgs.where(F.col("key") % REPLAY_EVERY == 0), topic, files=2)
    run()
    columns = [_number(), *BRONZE_COLUMNS]
    return spark.read.parquet(sink).select(F.lit(False).alias("late"), *columns).unionByName(
        spark.read.parquet(late).select(F.lit(True).alias("late"), *columns))


@query("to_json_roundtrip", O.EVENTS_ROUNDTRIP)
def q_to_json_roundtrip(spark: SparkSession, sf_dir: str):
    """S6 + P2: rows -> JSON messages -> rows with the fixed schema."""
    pin_session(spark)
    events = read_table(spark, sf_dir, "events")
    schema = events.drop("event_id").schema
    msgs = as_messages(events, key_col="event_id")
    parsed = msgs.select(F.col("key").cast("string").cast("long").alias("event_id"),
                         parse_json(F.col("value").cast("string"), schema).alias("e"))
    return parsed.select("event_id", "e.*")


@query("partition_scan", O.BRONZE_SCAN)
def q_partition_scan(spark: SparkSession, sf_dir: str):
    """One date of a date-partitioned table, read from its root
    (``PartitionFilters`` prune the other directories)."""
    pin_session(spark)
    return read_layer(spark, X.landed_bronze_events(spark, sf_dir), SCAN_DATE)


@query("partition_overwrite", O.BRONZE_RERUN)
def q_partition_overwrite(spark: SparkSession, sf_dir: str):
    """A first load lands every third message twice on every date; a
    rerun for the dates in ``RERUN_DATES`` rewrites only those dates, from
    the clean messages.  Other dates keep the first load's rows."""
    pin_session(spark)
    path = fresh_path(spark, "bronze-rerun")
    msgs = X.envelope_messages(spark, sf_dir)
    overwrite_partitions(bronze_ingest(X.duplicated_messages(msgs), X.event_day()), path)
    lo, hi = (X.as_date(d) for d in RERUN_DATES)
    rerun = bronze_ingest(msgs, X.event_day()).where(F.col("partition_date").between(lo, hi))
    overwrite_partitions(rerun, path)
    return spark.read.parquet(path).select(*BRONZE_COLUMNS)


@query("retention_purge", O.BRONZE_RETAINED)
def q_retention_purge(spark: SparkSession, sf_dir: str):
    """R3 as the retention job runs it on the table of an ingest stream: dates before the
    cutoff are dropped from the table itself, by directory, without reading or
    rewriting a row."""
    pin_session(spark)
    topic, path = fresh_path(spark, "topic-purged"), fresh_path(spark, "bronze-purged")
    S.land_messages(X.envelope_messages(spark, sf_dir), topic, files=4)
    S.ingest_with_quarantine(S.read_messages(spark, "files", topic), path,
                             fresh_path(spark, "bad-purged"), fresh_path(spark, "ckpt-purged"),
                             X.event_day())
    purge_before(spark, path, RETENTION_CUTOFF)
    return spark.read.parquet(path).select(*BRONZE_COLUMNS)


@query("retention_keep", O.BRONZE_RETAINED)
def q_retention_keep(spark: SparkSession, sf_dir: str):
    """Keep the dates on or after the cutoff, written to a new table root
    (a purge by rewrite; directories below the cutoff are never read)."""
    pin_session(spark)
    cutoff = X.as_date(RETENTION_CUTOFF)
    kept = read_layer(spark, X.landed_bronze_events(spark, sf_dir)).where(
        F.col("partition_date") >= cutoff)
    out = fresh_path(spark, "bronze-retained")
    overwrite_partitions(kept, out)
    return spark.read.parquet(out).select(*BRONZE_COLUMNS)
