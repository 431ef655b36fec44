"""Command-line entry points for the pipeline's jobs (``spark-submit`` or ``python -m``).

    python -m ingot.jobs bronze-to-silver BRONZE GAMES PARTICIPANTS TEAMS_STATS TEAMS_BANS DATE
        [--quarantine PATH] [--skip-seen [--look-back DAYS]]
    python -m ingot.jobs silver-to-gold GAMES PARTICIPANTS TEAMS_STATS TEAMS_BANS \\
        MATCH_SUMMARY PLAYER_PERFORMANCE TEAM_PERFORMANCE DATE
    python -m ingot.jobs ingest SINK CHECKPOINT SOURCE [--quarantine PATH] [--date DATE]
        [--dedupe SECONDS]
    python -m ingot.jobs publish-seeds SNAPSHOTS SINK [--taken-at TIME]
    python -m ingot.jobs enrich-details IDENTITY HISTORY SINK RETRY QUARANTINE CHECKPOINT SOURCE
    python -m ingot.jobs enrich-matches DOCUMENTS SINK RETRY QUARANTINE CHECKPOINT SOURCE
    python -m ingot.jobs redrive-details RETRY STATE IDENTITY HISTORY SINK DEAD [--landed TABLE]
    python -m ingot.jobs redrive-matches RETRY STATE DOCUMENTS SINK DEAD
        [--max-attempts N] [--backoff SECONDS] [--at TIME]
    python -m ingot.jobs refresh-lookup SOURCE_PATH KEY TABLE PATH --buckets N [--latest N]
    python -m ingot.jobs throughput BRONZE SINK [DATE]
    python -m ingot.jobs follow-throughput SINK CHECKPOINT SOURCE [--delay "10 minutes"]
    python -m ingot.jobs retention ROOT CUTOFF
    python -m ingot.jobs compact ROOT DATE [--target-bytes N]
    python -m ingot.jobs vacuum ROOT [--older-than SECONDS]

SOURCE is ``--kafka BOOTSTRAP --topic TOPIC`` or ``--files DIR``, with
``[--max-per-trigger N] [--min-partitions N] [--processing-time "1 minute"]``;
SINK of the enrichment jobs is a directory, or a topic with ``--sink-kafka
BOOTSTRAP``.  IDENTITY, HISTORY and DOCUMENTS are names in the catalog, as
``refresh-lookup`` writes them: each refresh is a new table and switches the view TABLE,
which a running stream resolves anew for every micro-batch.

The positional arguments of the daily jobs follow the reference's (table roots,
then the date).  The date is explicit and is the output date too, and every
write replaces only that date.  The session comes from ``getOrCreate``, so the
cluster's settings (including ``spark.checkpoint.dir``) apply.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import ISO_PATTERN
from .operators import enrich as E
from .operators import monitor as T
from .operators import retry as R
from .plans.silver import run_bronze_to_silver, run_silver_to_gold
from .session import pin_session
from .sources.compaction import compact, vacuum
from .sources.sinks import (
    overwrite_partitions,
    publish_version,
    purge_before,
    replace_date,
    write_messages,
)
from .sources.tables import read_layer, read_snapshots
from .streaming import enrich as H
from .streaming import ingest as S
from .streaming.throughput import follow_throughput


def _stream_arguments(p: argparse.ArgumentParser) -> None:
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="BOOTSTRAP")
    src.add_argument("--files", metavar="DIR")
    p.add_argument("--topic", default="matchs")
    p.add_argument("--date", help="load date (default: the day of ingestion)")
    p.add_argument("--max-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int, help="split topic partitions into more tasks")
    p.add_argument("--processing-time", help="run continuously on this trigger")
    p.add_argument("--files-per-batch", type=int,
                   help="deal each micro-batch out to this many files")


def _sink_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--sink-kafka", metavar="BOOTSTRAP", help="SINK is a topic there")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ingot.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str) -> argparse.ArgumentParser:
        j = sub.add_parser(name)
        for arg in positional:
            j.add_argument(arg)
        return j
    b = job("bronze-to-silver", "bronze", "games", "participants", "teams_stats", "teams_bans",
            "date")
    b.add_argument("--quarantine")
    b.add_argument("--skip-seen", action="store_true")
    b.add_argument("--look-back", type=int, default=30, help="days of silver that --skip-seen reads")
    job("silver-to-gold", "games", "participants", "teams_stats", "teams_bans", "match_summary",
        "player_performance", "team_performance", "date")
    i = job("ingest", "sink", "checkpoint")
    i.add_argument("--quarantine")
    i.add_argument("--dedupe", type=int, metavar="SECONDS",
                   help="land each key once within this delay; older rows go to SINK_late")
    _stream_arguments(i)
    s = job("publish-seeds", "snapshots", "sink")
    s.add_argument("--taken-at", help="stage time of the seeds (default: now)")
    _sink_arguments(s)
    for name, lookups in (("enrich-details", ("identity", "history")),
                          ("enrich-matches", ("documents",))):
        h = job(name, *lookups, "sink", "retry", "quarantine", "checkpoint")
        h.add_argument("--at", help="stage time of the hop (default: now)")
        _stream_arguments(h)
        _sink_arguments(h)
    for name, lookups in (("redrive-details", ("identity", "history")),
                          ("redrive-matches", ("documents",))):
        d = job(name, "retry", "state", *lookups, "sink", "dead")
        d.add_argument("--at", help="time of the run (default: now)")
        d.add_argument("--max-attempts", type=int, default=5)
        d.add_argument("--backoff", type=int, default=3600, metavar="SECONDS")
        d.add_argument("--landed", help="table whose rows need not be sent again")
        _sink_arguments(d)
    r = job("refresh-lookup", "source", "key", "table", "path")
    r.add_argument("--buckets", type=int, required=True)
    r.add_argument("--latest", type=int, help="keep lists of the latest N matches per key")
    t = job("throughput", "bronze", "sink")
    t.add_argument("date", nargs="?")
    f = job("follow-throughput", "sink", "checkpoint")
    f.add_argument("--delay", default="10 minutes", help="how late a message may be")
    _stream_arguments(f)
    job("retention", "root", "cutoff")
    c = job("compact", "root", "date")
    c.add_argument("--target-bytes", type=int, default=256 << 20)
    v = job("vacuum", "root")
    v.add_argument("--older-than", type=float, default=86_400, metavar="SECONDS")
    return p


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.kafka:
        return S.read_messages(spark, "kafka", "", S.kafka_options(
            args.kafka, args.topic, max_offsets=args.max_per_trigger,
            min_partitions=args.min_partitions))
    return S.read_messages(spark, "files", args.files, max_files=args.max_per_trigger)


def _options(args: argparse.Namespace) -> dict:
    return {"available_now": args.processing_time is None,
            "processing_time": args.processing_time, "files_per_batch": args.files_per_batch}


def _topic(args: argparse.Namespace) -> S.Output:
    if args.sink_kafka:
        return S.Output(lambda b: b.rows, args.sink, "kafka",
                        {"kafka.bootstrap.servers": args.sink_kafka})
    return S.Output(lambda b: b.rows, args.sink, "files")


def _lookup(spark: SparkSession, name: str):
    """A lookup by its name, resolved by each micro-batch, so that a refresh is seen."""
    return lambda: spark.table(name)


def _redrive(spark: SparkSession, args: argparse.Namespace) -> None:
    """One run over a hop's retry table; see ``operators/retry.py``."""
    now = dt.datetime.fromisoformat(args.at) if args.at else dt.datetime.now(dt.UTC)
    now = now if now.tzinfo else now.replace(tzinfo=dt.UTC)
    stage = F.lit(now.replace(tzinfo=None).isoformat(timespec="microseconds"))
    if args.job == "redrive-details":
        mark = R.mark_seeds(spark.table(args.identity), spark.table(args.history), stage)
    else:
        mark = R.mark_details(spark.table(args.documents), stage)

    def publish(rows: DataFrame, run: int) -> None:
        messages = S.check_messages(H.as_topic(rows, "match_id"))
        if args.sink_kafka:
            write_messages(messages, "kafka", args.sink, {"kafka.bootstrap.servers": args.sink_kafka})
        else:
            messages.write.mode("overwrite").parquet(f"{args.sink}/batch=redrive-{run:08d}")
    landed = read_layer(spark, args.landed) if args.landed else None
    R.redrive(read_layer(spark, args.retry), args.state, mark, publish, args.dead, now,
              args.max_attempts, args.backoff, landed)


def _throughput(spark: SparkSession, args: argparse.Namespace) -> None:
    """Throughput per load date; only the given date, or the dates there are, are replaced."""
    rows = read_layer(spark, args.bronze, args.date)
    counts = T.stage_throughput(rows, sort=False, by=("partition_date",))
    if args.date:
        replace_date(counts, args.sink, args.date, probe=rows)
    else:
        overwrite_partitions(counts, args.sink)


def _time(text: str | None):
    return F.lit(text) if text else F.date_format(F.current_timestamp(), ISO_PATTERN)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"ingot-{args.job}").getOrCreate()
    pin_session(spark)
    silver = ("games", "participants", "teams_stats", "teams_bans")
    query = None
    if args.job == "bronze-to-silver":
        run_bronze_to_silver(spark, args.bronze, {k: getattr(args, k) for k in silver}, args.date,
                             args.quarantine, args.skip_seen, args.look_back)
    elif args.job == "silver-to-gold":
        gold = ("match_summary", "player_performance", "team_performance")
        run_silver_to_gold(spark, {k: getattr(args, k) for k in silver},
                           {k: getattr(args, k) for k in gold}, args.date)
    elif args.job == "ingest":
        root = args.sink.rstrip("/")
        bad = args.quarantine or f"{root}_quarantine"
        if args.dedupe is None:
            query = S.ingest_with_quarantine(_messages(spark, args), root, bad, args.checkpoint,
                                             args.date, **_options(args))
        else:
            query = S.ingest_deduplicated(_messages(spark, args), root, bad, f"{root}_late",
                                          args.checkpoint, args.dedupe, args.date,
                                          **_options(args))
    elif args.job == "publish-seeds":
        seeds = E.seed_entries(read_snapshots(spark, args.snapshots), _time(args.taken_at))
        out, topic = H.as_topic(seeds, "summonerId"), _topic(args)
        write_messages(out, "kafka" if topic.fmt == "kafka" else "parquet", topic.path, topic.options)
    elif args.job == "enrich-details":
        query = H.enrich_details(
            _messages(spark, args), _lookup(spark, args.identity), _lookup(spark, args.history),
            _time(args.at), _topic(args), args.retry, args.quarantine, args.checkpoint, args.date,
            **_options(args))
    elif args.job == "enrich-matches":
        query = H.enrich_matches(
            _messages(spark, args), _lookup(spark, args.documents), _time(args.at), _topic(args),
            args.retry, args.quarantine, args.checkpoint, args.date, **_options(args))
    elif args.job in ("redrive-details", "redrive-matches"):
        _redrive(spark, args)
    elif args.job == "refresh-lookup":
        rows = spark.read.parquet(args.source)
        if args.latest:
            rows = E.history_lists(rows, args.latest, args.key)
        publish_version(rows, args.key, args.table, args.path, args.buckets)
    elif args.job == "throughput":
        _throughput(spark, args)
    elif args.job == "follow-throughput":
        query = follow_throughput(_messages(spark, args), args.sink, args.checkpoint, args.delay,
                                  **_options(args))
    elif args.job == "compact":
        compact(spark, args.root, args.date, args.target_bytes)
    elif args.job == "vacuum":
        vacuum(spark, args.root, args.older_than)
    else:
        purge_before(spark, args.root, args.cutoff)
    if query is not None and args.processing_time:
        query.awaitTermination()


if __name__ == "__main__":
    main()
