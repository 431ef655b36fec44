"""Monitoring queries: stage throughput and latency over the bronze table, and
the dashboard panels re-aimed as metric-sample queries (L9, L11, R2).

Stage inputs: the bronze table landed from the event messages.  Metric inputs:
``events`` as labelled samples (topic = event_type, partition = user_id % 3).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import oracle_monitor as O
from ..operators import metrics as M
from ..operators import monitor as T
from ..registry import query
from ..session import fresh_path, pin_session
from ..sources import fixtures as X
from ..sources.tables import read_samples
from ..streaming import ingest as S
from ..streaming.throughput import follow_throughput

RANGE_S = 3600          # trailing range of delta / rate (the test data is sparse)
RANK_ERROR = 0.01       # how far a sketched quantile's rank may be off
STALENESS_S = 300       # how long an instant value counts
RECENT_HOURS = 6        # the dashboards' default time range
SERIES = ["topic", "partition"]


def _bronze(spark, sf_dir):
    pin_session(spark)
    return X.landed_bronze_stage_table(spark, sf_dir)


def _landed(spark, sf_dir, name, start=None):
    """A landed metric table through the reader; only samples after ``start``."""
    pin_session(spark)
    return read_samples(spark, X.landed_samples(spark, sf_dir, name), start, after_start=True)


def _samples(spark, sf_dir, start=None):
    s = M.select_series(_landed(spark, sf_dir, "topics", start), X.METRIC_NAME, job=X.METRIC_JOB)
    return s.withColumns({"topic": M.label("topic"), "partition": M.label("partition")})


def _time():
    """A sample's time without its zone, as the tables have it."""
    return F.col("ts").cast("timestamp_ntz").alias("ts")


@query("stage_throughput", O.STAGE_THROUGHPUT)
def q_stage_throughput(spark: SparkSession, sf_dir: str):
    """Rows per minute in each stage, one pivot."""
    return T.stage_throughput(_bronze(spark, sf_dir))


@query("throughput_stream", O.STAGE_THROUGHPUT)
def q_throughput_stream(spark: SparkSession, sf_dir: str):
    """L9 while the stream runs: closed minutes of an event-time aggregate, in two runs on one
    checkpoint.  A heartbeat (a message from far ahead) closes the last minutes."""
    pin_session(spark)
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("topic-live", "live", "ckpt-live"))
    msgs = X.envelope_messages(spark, sf_dir)
    half = (msgs.agg(F.max("key")).first()[0] or 0) // 2

    def run(rows):
        S.land_messages(rows, topic, files=2)
        follow_throughput(S.read_messages(spark, "files", topic), sink, ckpt, "1 hour")
    run(msgs.where(F.col("key") <= half))
    run(msgs.where(F.col("key") > half))
    run(X.heartbeat(spark))
    return spark.read.parquet(sink).select("minute", *T.STAGES)


@query("stage_throughput_distinct", O.STAGE_THROUGHPUT_DISTINCT)
def q_stage_throughput_distinct(spark: SparkSession, sf_dir: str):
    """Q11 variant: distinct stage events per minute."""
    return T.stage_throughput_distinct(_bronze(spark, sf_dir))


@query("stage_throughput_join", O.STAGE_THROUGHPUT)
def q_stage_throughput_join(spark: SparkSession, sf_dir: str):
    """The same table via full outer joins of per-stage counts."""
    return T.stage_throughput_join(_bronze(spark, sf_dir))


@query("throughput_long", O.THROUGHPUT_LONG)
def q_throughput_long(spark: SparkSession, sf_dir: str):
    """Throughput as (minute, stage, value) rows."""
    return T.throughput_long(T.stage_throughput(_bronze(spark, sf_dir), sort=False))


@query("stage_latency", O.STAGE_LATENCY)
def q_stage_latency(spark: SparkSession, sf_dir: str):
    """R2: seconds between stages, per hop and hour."""
    return T.stage_latency(_bronze(spark, sf_dir))


@query("stage_latency_sketch", O.STAGE_LATENCY_SKETCH)
def q_stage_latency_sketch(spark: SparkSession, sf_dir: str):
    """R2 from stored sketches: a sketch per minute and hop is landed, merged into hours and
    days, and each quantile's rank compared with all values' ranks."""
    pin_session(spark)
    bronze, path = _bronze(spark, sf_dir), fresh_path(spark, "latency-sketches")
    T.latency_sketches(bronze).write.parquet(path)
    stored = spark.read.parquet(path)
    shares = {"p50": 0.5, "p95": 0.95}
    out = None
    for unit in ("hour", "day"):
        found = T.rank_errors(bronze, T.merge_sketches(stored, unit, shares), unit, shares)
        rows = found.select(F.lit(unit).alias("unit"), F.col(unit).alias("start"), "hop", "n", (
            F.col("n") == F.col("values")).alias("whole"),
            *((F.col(name) <= RANK_ERROR).alias(f"{name}_close") for name in shares))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("metric_select", O.METRIC_SELECT)
def q_metric_select(spark: SparkSession, sf_dir: str):
    """Two label predicates."""
    s = M.select_series(_landed(spark, sf_dir, "topics"), X.METRIC_NAME,
                        job=X.METRIC_JOB, topic="purchase")
    return s.select(_time(), M.label("partition").alias("partition"), "value")


@query("metric_recent", O.METRIC_RECENT)
def q_metric_recent(spark: SparkSession, sf_dir: str):
    """The trailing six hours before the newest sample."""
    now = M.newest(_samples(spark, sf_dir))
    start = now and now - dt.timedelta(hours=RECENT_HOURS)
    s = M.last_hours(_samples(spark, sf_dir, start), RECENT_HOURS, now)
    return s.select(_time(), *SERIES, "value")


@query("metric_gauge_mb", O.METRIC_GAUGE_MB)
def q_metric_gauge_mb(spark: SparkSession, sf_dir: str):
    """Heap panels: bytes -> MiB."""
    return M.to_mebibytes(_samples(spark, sf_dir)).select(_time(), *SERIES, "value_mb")


@query("metric_legend", O.METRIC_LEGEND)
def q_metric_legend(spark: SparkSession, sf_dir: str):
    """Series names from a label template and a regex rename."""
    s = _samples(spark, sf_dir)
    return s.select(_time(),
                    M.legend("%s/%s", SERIES, r"^(\w+)/(\d+)$", "$1 p$2").alias("legend"),
                    M.legend("%s", ["state"]).alias("state"), "value")


@query("metric_delta", O.METRIC_DELTA)
def q_metric_delta(spark: SparkSession, sf_dir: str):
    """Change over the trailing hour per series, per minute."""
    d = M.delta(_samples(spark, sf_dir), SERIES, RANGE_S, per_s=60)
    return d.select(_time(), *SERIES, F.round("delta", 6).alias("delta_per_min"))


@query("metric_messages_per_minute_grid", O.METRIC_MESSAGES_PER_MINUTE_GRID)
def q_metric_messages_per_minute_grid(spark: SparkSession, sf_dir: str):
    """A6 over W2 as a dashboard evaluates it: ``sum(delta(x[range]) / n) by
    (topic)`` at every minute of a 1-minute grid."""
    d = M.delta_on_grid(_samples(spark, sf_dir), SERIES, RANGE_S, step_s=60, per_s=60)
    s = M.sum_by(d, "delta", ["topic", "t"], "messages_per_min")
    return s.withColumn("messages_per_min", F.round("messages_per_min", 6))


@query("metric_heap", O.METRIC_HEAP)
def q_metric_heap(spark: SparkSession, sf_dir: str):
    """Heap panel: used against maximum, two metrics of one area and job side by side."""
    s = _landed(spark, sf_dir, "nodes")
    both = s.where(F.col("metric").isin(X.HEAP_USED, X.HEAP_MAX)
                   & (M.label("area") == "heap") & (M.label("job") == X.NODE_JOB))
    both = M.to_mebibytes(both).withColumn("instance", M.label("instance"))
    return M.side_by_side(both.withColumn("ts", _time()), "metric", "value_mb", ["ts", "instance"],
                          {X.HEAP_USED: "used_mb", X.HEAP_MAX: "max_mb"})


@query("metric_bytes_grid", O.METRIC_BYTES_GRID)
def q_metric_bytes_grid(spark: SparkSession, sf_dir: str):
    """Change of bytes in and out per minute of each broker, two counters on the grid
    (``delta``; the traffic panel is ``metric_bytes_rate_grid``)."""
    s = _landed(spark, sf_dir, "nodes").where(F.col("metric").isin(X.BYTES_IN, X.BYTES_OUT))
    s = s.withColumn("instance", M.label("instance"))
    d = M.delta_on_grid(s, ["metric", "instance"], RANGE_S, step_s=60, per_s=60)
    wide = M.side_by_side(d, "metric", "delta", ["instance", "t"], {
        X.BYTES_IN: "bytes_in_per_min", X.BYTES_OUT: "bytes_out_per_min"})
    return wide.withColumns({c: F.round(c, 6) for c in ("bytes_in_per_min", "bytes_out_per_min")})


@query("metric_bytes_rate_grid", O.METRIC_BYTES_RATE_GRID)
def q_metric_bytes_rate_grid(spark: SparkSession, sf_dir: str):
    """Traffic panel: bytes a second into and out of each broker, as rates of two counters
    that start again now and then, at every minute."""
    s = _landed(spark, sf_dir, "panels").where(F.col("metric").isin(X.BYTES_IN, X.BYTES_OUT))
    r = M.rate_on_grid(s.withColumn("instance", M.label("instance")), ["metric", "instance"],
                       RANGE_S, step_s=60)
    wide = M.side_by_side(r, "metric", "rate", ["instance", "t"], {
        X.BYTES_IN: "bytes_in_per_s", X.BYTES_OUT: "bytes_out_per_s"})
    return wide.withColumns({c: F.round(c, 6) for c in ("bytes_in_per_s", "bytes_out_per_s")})


@query("metric_instant_grid", O.METRIC_INSTANT_GRID)
def q_metric_instant_grid(spark: SparkSession, sf_dir: str):
    """CPU, thread and heap panels: the last sample of each node at every minute, while it is
    not stale, side by side."""
    s = _landed(spark, sf_dir, "panels").where(
        F.col("metric").isin(X.CPU_SECONDS, X.THREADS, X.HEAP_USED) & (M.label("job") == X.NODE_JOB))
    v = M.instant_on_grid(s.withColumn("instance", M.label("instance")), ["metric", "instance"],
                          STALENESS_S)
    return M.side_by_side(v, "metric", "value", ["instance", "t"], {
        X.CPU_SECONDS: "cpu_seconds", X.THREADS: "threads", X.HEAP_USED: "heap_bytes"})


@query("metric_thread_states_grid", O.METRIC_THREAD_STATES_GRID)
def q_metric_thread_states_grid(spark: SparkSession, sf_dir: str):
    """Threads-by-state panel: each state's threads at every minute, summed over the nodes."""
    s = M.select_series(_landed(spark, sf_dir, "panels"), X.THREAD_STATES, job=X.NODE_JOB)
    s = s.withColumns({"instance": M.label("instance"), "state": M.label("state")})
    v = M.instant_on_grid(s, ["instance", "state"], STALENESS_S)
    return M.sum_by(v, "value", ["state", "t"], "threads")


@query("metric_rate", O.METRIC_RATE)
def q_metric_rate(spark: SparkSession, sf_dir: str):
    """Reset-aware per-second rate over the trailing hour."""
    r = M.rate(_samples(spark, sf_dir), SERIES, RANGE_S)
    return r.select(_time(), *SERIES, F.round("rate", 6).alias("rate"))
