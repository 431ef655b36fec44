"""Streams that land once, on any day, whatever the age of the table; compaction; live lookups."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from ingot import jobs
from ingot.functions.schemas import DETAIL_SCHEMA, SEED_SCHEMA
from ingot.operators import enrich as E
from ingot.operators import monitor as T
from ingot.session import fresh_path
from ingot.sources import compaction as C
from ingot.sources.sinks import as_messages, publish_version, purge_before
from ingot.sources.tables import read_layer
from ingot.streaming import enrich as H
from ingot.streaming import ingest as S
from ingot.streaming import ledger
from ingot.streaming.throughput import follow_throughput


def message(at, **more):
    return json.dumps({"timestamp_summoner": at, **more}).encode()


def land(spark, topic, rows, files=1):
    S.land_messages(spark.createDataFrame(rows, "key long, value binary"), topic, files=files)


def paths(spark, *names):
    return [fresh_path(spark, f"st-{n}") for n in names]


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def forget_last_commit(checkpoint):
    """As if the driver died after a batch's last output and before Spark noted it."""
    folder = f"{local(checkpoint)}/commits"
    last = max(n for n in os.listdir(folder) if n.isdigit())
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{folder}/{name}"):
            os.remove(f"{folder}/{name}")


# Topics take bytes

MESSAGE = {"key": "binary", "value": "binary"}


def test_every_topic_output_is_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(H, "run_split", lambda stream, outputs, *a, **k: seen.append(outputs[0]))
    out = S.Output(lambda b: b.rows, "topic", "kafka", {"kafka.bootstrap.servers": "x:1"})
    messages = spark.createDataFrame([(b"k", b"{}")], "key binary, value binary")
    H.enrich_details(messages, None, None, "t", out, "r", "q", "c")
    H.enrich_matches(messages, None, "t", out, "r", "q", "c")
    base = spark.createDataFrame([(None, None, None, None)], SEED_SCHEMA.simpleString()[7:-1].replace(
        ":", " ") + ", match_id string, reason string").withColumn("_bad", F.lit(False))
    details = base.withColumn("timestamp_summoner_details", F.lit("t"))
    matches = details.withColumns({"timestamp_match": F.lit("t"), "match_details": F.lit("{}")})
    assert {f.name for f in DETAIL_SCHEMA} <= set(details.columns)
    for output, rows in zip(seen, (details, matches), strict=True):
        assert (output.fmt, output.path) == ("kafka", "topic")
        made = output.select(ledger.Batch(rows, "t", dt.date(2024, 1, 1)))
        assert dict(made.dtypes) == MESSAGE and S.check_messages(made) is made
    seeds = E.seed_entries(spark.createDataFrame([([("a",)],)], "entries array<struct<summonerId:string>>"),
                           "t")
    assert dict(H.as_topic(seeds, "summonerId").dtypes) == MESSAGE
    assert dict(as_messages(seeds, "summonerId").dtypes) == MESSAGE
    assert dict(S.MESSAGE_SCHEMA.jsonValue() and [(f.name, f.dataType.simpleString())
                                                  for f in S.MESSAGE_SCHEMA]) == MESSAGE


def test_a_topic_refuses_other_types(spark):
    with pytest.raises(ValueError, match="string or binary"):
        S.check_messages(spark.createDataFrame([(1, b"x")], "key long, value binary"))
    with pytest.raises(ValueError, match="string or binary"):
        S.check_messages(spark.createDataFrame([("x",)], "key string"))


# A repeated batch

@pytest.mark.parametrize("dedupe", [False, True])
def test_a_batch_repeated_on_the_next_day_lands_once(spark, monkeypatch, dedupe):
    topic, sink, bad, late, ckpt = paths(spark, "topic", "sink", "bad", "late", "ckpt")

    def run(day):
        monkeypatch.setattr(ledger, "today", lambda spark: dt.date(2024, 5, day))
        stream = S.read_messages(spark, "files", topic, max_files=1)
        if dedupe:
            S.ingest_deduplicated(stream, sink, bad, late, ckpt, 3600)
        else:
            S.ingest_with_quarantine(stream, sink, bad, ckpt)

    def landed():
        return [sorted((str(r.partition_date), *(r[c] for c in r.asDict() if c not in (
            "partition_date", "batch", "event_time"))) for r in spark.read.parquet(p).collect())
            for p in ((sink, bad, late) if dedupe else (sink, bad))]
    land(spark, topic, [(i, message(f"2024-01-01T10:{i:02}:00")) for i in range(20)] + [(30, b"{cut")])
    run(1)
    land(spark, topic, [(i, message(f"2024-01-01T12:{i:02}:00")) for i in range(40, 60)] + [
        (31, b"{cut"), (32, message("2024-01-01T01:00:00")), (33, message("2024-01-01T12:00:30"))])
    run(2)
    first = landed()
    forget_last_commit(ckpt)
    run(3)                                        # the same batch again, a day later
    assert landed() == first
    assert {r[0] for table in first for r in table} == {"2024-05-01", "2024-05-02"}
    land(spark, topic, [(99, message("2024-01-01T12:50:00"))])
    run(3)
    assert len(landed()[0]) == len(first[0]) + 1


def test_the_ledger_keeps_a_bounded_number_of_entries(spark, monkeypatch):
    monkeypatch.setattr(ledger, "KEPT", 3)
    (ckpt,) = paths(spark, "ledger")
    noon = dt.datetime(2024, 1, 1, 12, tzinfo=dt.UTC)
    for i in range(8):
        day, before, newest = ledger.enter(spark, ckpt, "q", i,
                                           lambda i=i: noon - dt.timedelta(hours=i % 3))
        assert before == (noon if i else None) and newest == noon
    again = ledger.enter(spark, ckpt, "q", 7, lambda: noon + dt.timedelta(days=9))
    assert again == (day, noon, noon)             # as first written
    assert len(os.listdir(f"{local(ckpt)}/ledger")) <= 2 * 5


# The index of landed keys

def test_landed_keys_are_looked_up_in_their_hours_only(spark):
    topic, sink, bad, late, ckpt = paths(spark, "k-topic", "k-sink", "k-bad", "k-late", "k-ckpt")
    for day in range(1, 6):
        land(spark, topic, [(100 * day + h, message(f"2024-01-{day:02}T{h:02}:30:00")) for h in range(24)]
             + [(None, message(f"2024-01-{day:02}T23:00:00"))])
        S.ingest_deduplicated(S.read_messages(spark, "files", topic), sink, bad, late, ckpt, 7200)
    hours = sorted(n for n in os.listdir(f"{local(S.keys_path(sink))}") if n.startswith("hour="))
    assert hours[0] >= "hour=2024-01-04-21" and len(hours) <= 27     # cut off at the delay
    keys = S.landed_keys(spark, sink, dt.datetime(2024, 1, 5, 20, tzinfo=dt.UTC))
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan and "2024-01-05-20" in plan
    assert sink + "/" not in plan and f"{sink}_keys" in plan          # nothing of the table itself
    assert sorted(int(r.key) for r in keys.collect()) == [521, 522, 523]
    assert spark.read.parquet(sink).where("key IS NULL").count() == 5


def test_repeats_are_looked_for_in_bounded_partitions(spark, monkeypatch):
    """Rows are dealt out by key before whole rows are sorted to drop repeats."""
    topic, sink, bad, late, ckpt = paths(spark, "b-topic", "b-sink", "b-bad", "b-late", "b-ckpt")
    land(spark, topic, [(i % 60, message(f"2024-01-01T10:{i % 60:02}:00")) for i in range(120)])
    monkeypatch.setattr(S, "JUDGED_ROWS", 5, raising=False)
    dealt, plain = [], DataFrame.repartition

    def repartition(df, *by):
        dealt.append(by)
        return plain(df, *by)
    monkeypatch.setattr(DataFrame, "repartition", repartition)
    S.ingest_deduplicated(S.read_messages(spark, "files", topic), sink, bad, late, ckpt, 3600)
    assert (24, "key") in dealt
    assert spark.read.parquet(sink).count() == 60


# Retention

def test_retention_refuses_a_table_with_a_commit_log(spark):
    topic, sink = paths(spark, "r-topic", "r-sink")
    land(spark, topic, [(1, message("2024-01-01T10:00:00"))])
    S.bronze_stream(spark, "files", topic, sink, partition_date="2024-01-01")
    with pytest.raises(ValueError, match="commit log"):
        purge_before(spark, sink, "2024-02-01")
    assert spark.read.parquet(sink).count() == 1


# Compaction

def ingest_many(spark, n, rows_each=3):
    topic, sink, bad, ckpt = paths(spark, "c-topic", "c-sink", "c-bad", "c-ckpt")
    for i in range(n):
        land(spark, topic, [(i * 10 + k, message(f"2024-01-01T10:00:{i:02}.{k:06}")) for k in range(rows_each)])
    S.ingest_with_quarantine(S.read_messages(spark, "files", topic, max_files=1), sink, bad, ckpt,
                             "2024-01-02")
    return topic, sink, bad, ckpt


def times(df):
    return sorted(r.timestamp_summoner for r in df.collect())


def test_compaction_keeps_rows_and_readers_whole(spark):
    topic, sink, bad, ckpt = ingest_many(spark, 6)
    before = times(read_layer(spark, sink))
    reader = read_layer(spark, sink, "2024-01-02")                    # resolved before
    jobs.main(["compact", sink, "2024-01-02", "--target-bytes", "100000000"], spark=spark)
    assert times(reader) == before                                    # goes on reading the old files
    after = read_layer(spark, sink, "2024-01-02")
    assert times(after) == before
    live = C.live_batches(spark, sink, "2024-01-02")
    assert len(live) == 2 and len(after.inputFiles()) == 2            # the merged one, the newest
    assert after.columns == reader.columns
    # The newest batch may be repeated: it replaces its own directory, which was left alone.
    forget_last_commit(ckpt)
    S.ingest_with_quarantine(S.read_messages(spark, "files", topic, max_files=1), sink, bad, ckpt,
                             "2024-01-02")
    assert times(read_layer(spark, sink)) == before
    jobs.main(["vacuum", sink, "--older-than", "0"], spark=spark)
    assert times(spark.read.parquet(sink).select("timestamp_summoner")) == before
    assert times(read_layer(spark, sink)) == before


def test_files_follow_the_bytes(spark):
    _, sink, _, _ = ingest_many(spark, 9, 40)
    small = C._settled(C.live_batches(spark, sink, "2024-01-02"))
    size = sum(C._size(spark, f"{sink}/partition_date=2024-01-02/{b}") for b in small)
    target = size // 3
    name = C.compact(spark, sink, "2024-01-02", target)
    made = [f for f in os.listdir(f"{local(sink)}/partition_date=2024-01-02/{name}")
            if f.endswith(".parquet")]
    assert 1 < len(made) <= size / target + 1
    assert C.compact(spark, sink, "2024-01-02", 1) is None            # all are large by that measure


def test_an_unpublished_directory_does_not_count(spark, monkeypatch):
    _, sink, _, _ = ingest_many(spark, 4)
    before = times(read_layer(spark, sink))
    C.compact(spark, sink, "2024-01-02")
    monkeypatch.setattr(C, "write_text", lambda *a: 1 / 0)
    _, other, _, _ = ingest_many(spark, 4)
    with pytest.raises(ZeroDivisionError):                            # dies before the note
        C.compact(spark, other, "2024-01-02")
    os.makedirs(f"{local(other)}/{C.NOTES}", exist_ok=True)
    assert times(read_layer(spark, other)) == before == times(read_layer(spark, sink))
    C.vacuum(spark, other, 0)
    assert times(spark.read.parquet(other)) == before


# Lookups that change under a stream

def test_a_refreshed_lookup_is_seen_by_the_next_batch(spark):
    topic, details, retry, bad, ckpt, root = paths(spark, "l-t", "l-d", "l-r", "l-b", "l-c", "l-v")
    lists = spark.createDataFrame([("PA", ["M1"]), ("PB", ["M2"])], "puuid string, match_ids array<string>")

    def publish(rows):
        publish_version(spark.createDataFrame(rows, "summonerId string, puuid string"), "summonerId",
                        "st_identity", root, 2)
    publish([("alice", "PA")])
    asked = []

    def identity():
        if len(asked) == 1:
            publish([("alice", "PA"), ("bob", "PB")])
        asked.append(spark.table("st_identity"))
        return asked[-1]
    for _ in range(2):
        S.land_messages(H.as_topic(spark.createDataFrame(
            [("t", "alice"), ("t", "bob")], "timestamp_summoner string, summonerId string"), "summonerId"),
            topic, files=1)
    H.enrich_details(S.read_messages(spark, "files", topic, max_files=1), identity, lists, "t2", details,
                     retry, bad, ckpt, "2024-01-01")
    sent = sorted(json.loads(bytes(r.value))["summonerId"] for r in spark.read.parquet(details).collect())
    assert len(asked) == 2 and sent == ["alice", "alice", "bob"]
    assert [r.summonerId for r in spark.read.parquet(retry).collect()] == ["bob"]
    assert asked[0].count() == 1                                      # the old version still reads
    publish([("alice", "PA")])
    names = [t.name for t in spark.catalog.listTables(pattern="st_identity__v*")]
    assert len(names) == 2 and spark.table("st_identity").count() == 1


# What a micro-batch keeps on disk, and shuffles, to be written

@pytest.fixture
def kept(monkeypatch):
    """Columns of every frame that is kept, and how many rows of each have a ``_raw`` text."""
    seen, plain = [], DataFrame.persist

    def persist(df, *level):
        out = plain(df, *level)
        seen.append((df.columns, out.where("_raw IS NOT NULL").count() if "_raw" in df.columns else 0))
        return out
    monkeypatch.setattr(DataFrame, "persist", persist)
    return seen


def test_hop_2_keeps_and_shuffles_no_document(spark, monkeypatch, kept):
    topic, matchs, retry, bad, ckpt = paths(spark, "w-t", "w-m", "w-r", "w-b", "w-c")
    documents = spark.createDataFrame([("M1", "one"), ("M2", "two"), ("M2", "again"), ("M3", None),
                                       (None, "lost"), ("M9", "unasked")],
                                      "match_id string, match_details string")
    details = [("t", "alice", "t1", m) for m in ("M1", "M1", "M2", "M3", "M4")]
    rows = spark.createDataFrame(details, DETAIL_SCHEMA)
    land(spark, topic, [(i, r.value) for i, r in enumerate(H.as_topic(rows, "match_id").collect())]
         + [(98, b"{cut"), (99, None)])
    monkeypatch.setattr(S, "DEALT_ROWS", 3, raising=False)
    monkeypatch.setattr(H, "WIDE_ROWS_PER_FILE", 2, raising=False)
    dealt, plain = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition",
                        lambda df, *by: dealt.append(df.columns) or plain(df, *by))
    H.enrich_matches(S.read_messages(spark, "files", topic), documents, "t2", matchs, retry, bad, ckpt,
                     "2024-01-01", files_per_batch=1)
    sent = [json.loads(bytes(r.value)) for r in spark.read.parquet(matchs).collect()]
    assert sorted((m["match_id"], m.get("match_details", "")) for m in sent) == [
        ("M1", "one"), ("M1", "one"), ("M2", "again"), ("M2", "two"), ("M3", "")]
    assert {(m["timestamp_summoner_details"], m["timestamp_match"]) for m in sent} == {("t1", "t2")}
    lost = spark.read.parquet(retry).select("match_id", "reason").collect()
    assert [tuple(r) for r in lost] == [("M4", "no_document")]
    assert spark.read.parquet(bad).count() == 2
    assert len(kept) == 2 and not any("match_details" in columns for columns, _ in kept)
    assert ["key", "value"] not in dealt                  # the messages stay in their tasks


def test_files_of_wide_messages_follow_the_rows(spark):
    topic, few, many, ckpt = paths(spark, "f-t", "f-few", "f-many", "f-c")
    land(spark, topic, [(i, message("2024-01-01T10:00:00")) for i in range(100)])
    S.run_split(S.read_messages(spark, "files", topic), [
        S.Output(lambda b: b.rows, few, "files"),
        S.Output(lambda b: b.rows, many, "files", rows_per_file=10)], ckpt, files_per_batch=2)
    files = [len(spark.read.option("recursiveFileLookup", "true").parquet(p).inputFiles())
             for p in (few, many)]
    assert files[0] <= 2 < files[1] <= 10
    assert spark.read.parquet(few).count() == spark.read.parquet(many).count() == 100


@pytest.mark.parametrize("dedupe", [False, True])
def test_an_ingest_keeps_the_text_of_bad_messages_only(spark, kept, dedupe):
    topic, sink, bad, late, ckpt = paths(spark, "g-t", "g-s", "g-b", "g-l", "g-c")
    good = [message("2024-01-01T10:00:00", match_details={"a": i}) for i in range(5)]
    land(spark, topic, list(enumerate([*good, b"{cut", b" "])))
    stream = S.read_messages(spark, "files", topic)
    if dedupe:
        S.ingest_deduplicated(stream, sink, bad, late, ckpt, 3600)
    else:
        S.ingest_with_quarantine(stream, sink, bad, ckpt)
    assert {n for _, n in kept} == {2}
    assert sorted(r.raw_message for r in spark.read.parquet(bad).collect()) == [" ", "{cut"]
    assert sorted(r.match_details for r in spark.read.parquet(sink).collect()) == [
        json.dumps({"a": i}, separators=(",", ":")) for i in range(5)]


def test_a_lookup_of_wide_rows_is_written_without_a_shuffle(spark, monkeypatch):
    from ingot.sources.sinks import publish_bucketed
    rows = spark.range(0, 2000, 1, 4).selectExpr("cast(id % 500 AS string) AS match_id",
                                                 "cast(id AS string) AS match_details")
    monkeypatch.setattr(DataFrame, "repartition", lambda *a: pytest.fail("shuffled"))
    table = publish_bucketed(rows, "match_id", "wide", 3, gather=False)
    assert sorted(table.collect()) == sorted(rows.collect())
    asked = spark.range(500).selectExpr("cast(id AS string) AS match_id").hint("merge")
    joined = asked.join(table.hint("merge"), "match_id")
    assert joined.count() == 2000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 3 out of 3" in plan and plan.count("Exchange hashpartitioning") <= 2


# Throughput while the stream runs

def test_closed_minutes_equal_the_batch_after_a_restart(spark):
    topic, sink, ckpt = paths(spark, "t-topic", "t-sink", "t-ckpt")
    rows = [(i, message(f"2024-01-01T{10 + i // 60:02}:{i % 60:02}:30",
                        timestamp_match=f"2024-01-01T{10 + i // 60:02}:{i % 60:02}:59"))
            for i in range(150) for _ in range(1 + i % 3)]

    def run(some):
        land(spark, topic, some)
        follow_throughput(S.read_messages(spark, "files", topic), sink, ckpt, "10 minutes")
    run(rows[:150])
    landed = spark.read.parquet(sink).count()
    assert 0 < landed < 150                                           # open minutes are held back
    run(rows[150:] + [(900, b"{cut")])
    run([(999, message("2100-01-01T00:00:00"))])
    run([(999, message("2100-01-01T00:00:00"))])
    bronze = spark.createDataFrame(
        [(json.loads(v)["timestamp_summoner"], None, json.loads(v)["timestamp_match"]) for _, v in rows],
        "timestamp_summoner string, timestamp_summoner_details string, timestamp_match string")
    want = sorted(map(tuple, T.stage_throughput(bronze).collect()))
    got = spark.read.parquet(sink).select("minute", *T.STAGES).collect()
    assert sorted(map(tuple, got)) == want
