"""Re-driving the retry tables (T6, Q14): what a lookup missed is asked again later.

Each retry row has a state: how often it was tried, when it may be tried again, and
whether it waits, was sent on, landed by another way, or is dead after too many tries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, list_names, path_exists, remove_path
from . import enrich as E

STATE = ("id string, timestamp_summoner string, summonerId string, match_id string, "
         "reason string, partition_date date, attempts int, not_before timestamp, status string")
REQUEST = ["timestamp_summoner", "summonerId", "match_id"]
WAITING, SENT, LANDED, DEAD = "waiting", "sent", "landed", "dead"


def request_id() -> F.Column:
    """A retry row's identity; rows of one seed and match are one request."""
    parts = [F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-")) for c in REQUEST]
    return F.sha2(F.concat_ws("\x00", *parts), 256)


def known_states(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """(number of the newest whole snapshot, its rows); 0 and no rows before the first."""
    done = [int(n.removeprefix("run=")) for n in list_names(spark, root) if n.startswith("run=")
            and path_exists(spark, f"{root.rstrip('/')}/{n}/_SUCCESS")]
    if not done:
        return 0, spark.createDataFrame([], STATE)
    return max(done), spark.read.schema(STATE).parquet(
        f"{root.rstrip('/')}/run={max(done):08d}")


def open_requests(retries: DataFrame, states: DataFrame) -> DataFrame:
    """All requests with their state; one that has none yet waits, once tried (by the hop)."""
    new = retries.select(*REQUEST, "reason", "partition_date").withColumn("id", request_id())
    new = new.groupBy("id", *REQUEST).agg(F.min("reason").alias("reason"),
                                          F.min("partition_date").alias("partition_date"))
    new = new.join(states.select("id"), "id", "left_anti").withColumns({
        "attempts": F.lit(1), "not_before": F.lit(None).cast("timestamp"), "status": F.lit(WAITING)})
    names = [c.split()[0] for c in STATE.split(", ")]
    return states.select(names).unionByName(new.select(names))


def redrive(retries: DataFrame, state: str, mark: Callable[[DataFrame], DataFrame],
            publish: Callable[[DataFrame, int], None], dead: str, now: dt.datetime,
            max_attempts: int = 5, backoff_s: int = 3600, landed: DataFrame | None = None,
            kept: int = 3) -> int:
    """Ask the lookups again for every request that is due; the run's number.

    ``mark`` looks rows up (``mark_history`` or ``mark_documents``); it gets the requests'
    columns and ``id`` and keeps ``id``.  What it finds goes to ``publish``.  A request that
    is missed again waits ``backoff_s`` seconds, twice as long after each further try, and
    is written to ``dead`` after ``max_attempts`` tries.  Requests that ``landed`` (with some
    of the request's columns) holds meanwhile are not sent again.

    The run's number is that of the snapshot of all states it writes last.  A run that failed
    before is repeated under the same number, so files it published are replaced (a
    topic gets them again, as at-least-once delivery does).
    """
    spark = retries.sparkSession
    last, states = known_states(spark, state)
    run, root = last + 1, state.rstrip("/")
    staged = fresh_path(spark, "redrive")
    try:
        open_requests(retries, states).write.parquet(f"{staged}/open")
        requests = spark.read.schema(STATE).parquet(f"{staged}/open")
        at = F.lit(now)
        due = requests.where((F.col("status") == WAITING) & (
            F.col("not_before").isNull() | (F.col("not_before") <= at)))
        if landed is not None:
            on = [c for c in REQUEST if c in landed.columns]
            here = due.join(landed.select(on).distinct(), on, "left_semi").select("id")
            here.withColumn("to", F.lit(LANDED)).write.parquet(f"{staged}/landed")
            here = spark.read.schema("id string, to string").parquet(f"{staged}/landed")
            due = due.join(here, "id", "left_anti")
        mark(due.drop("reason", "partition_date", "attempts", "not_before", "status")
             ).write.parquet(f"{staged}/marked")
        marked = spark.read.parquet(f"{staged}/marked")
        publish(E.enriched(marked), run)
        outcome = marked.groupBy("id").agg(F.max("reason").alias("again")).withColumn(
            "to", F.when(F.col("again").isNull(), SENT))
        if landed is not None:
            outcome = outcome.unionByName(here, allowMissingColumns=True)
        tried = requests.join(outcome, "id", "left")
        asked = F.col("again").isNotNull() | F.coalesce(F.col("to") == SENT, F.lit(False))
        attempts = F.col("attempts") + asked.cast("int")
        status = F.when(F.col("to").isNotNull(), F.col("to")).when(
            asked & (attempts >= max_attempts), DEAD).otherwise(F.col("status"))
        wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (
            F.lit(backoff_s) * F.pow(F.lit(2), F.col("attempts") - 1)).cast("decimal(18,6)"))
        result = tried.withColumns({
            "attempts": attempts, "status": status, "reason": F.coalesce("again", "reason"),
            "not_before": F.when(asked & (status == WAITING), at + wait).otherwise(F.col("not_before"))
        }).select([c.split()[0] for c in STATE.split(", ")])
        result.write.mode("overwrite").parquet(f"{staged}/states")
        result = spark.read.schema(STATE).parquet(f"{staged}/states")
        buried = result.where(F.col("status") == DEAD).join(
            states.where(F.col("status") == DEAD).select("id"), "id", "left_anti")
        buried.withColumn("run", F.lit(run)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(dead)
        result.write.mode("overwrite").parquet(f"{root}/run={run:08d}")
    finally:
        remove_path(spark, staged)
    for n in list_names(spark, root):
        if n.startswith("run=") and int(n[4:]) <= run - kept:
            remove_path(spark, f"{root}/{n}")
    return run


def mark_seeds(identity: DataFrame, lists: DataFrame, processed_at) -> Callable:
    """Hop 1 for ``redrive``: seeds -> their recent matches."""
    return lambda due: E.mark_history(due.drop("match_id"), identity, lists, processed_at,
                                      keep=("id",))


def mark_details(documents: DataFrame, fetched_at) -> Callable:
    """Hop 2 for ``redrive``: matches -> their documents.  The retry table does not keep when
    the match was first looked up, so that stage's time is the re-drive's."""
    def mark(due: DataFrame) -> DataFrame:
        at = fetched_at if isinstance(fetched_at, F.Column) else F.lit(fetched_at)
        return E.mark_documents(due.withColumn("timestamp_summoner_details", at), documents, at)
    return mark
