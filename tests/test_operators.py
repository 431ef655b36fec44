"""Operator tests: enrichment lookups, trailing windows, streams, join planning."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ingot.operators import enrich as E
from ingot.operators import metrics as M
from ingot.operators import privacy as P
from ingot.operators.joins import lookup_join
from ingot.session import fresh_path
from ingot.streaming import ingest as S


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- enrichment (Q13, Q15, P10, O2) ------------------------------------------

def test_unknown_player_and_player_without_matches_are_dropped(spark):
    seeds = spark.createDataFrame([("t0", "alice"), ("t0", "bob"), ("t0", "nobody")],
                                  "timestamp_summoner string, summonerId string")
    identity = spark.createDataFrame([("alice", "PA"), ("bob", "PB")], "summonerId string, puuid string")
    base = dt.datetime(2024, 1, 1)
    history = spark.createDataFrame(
        [("PA", f"M{i}", base + dt.timedelta(hours=i)) for i in range(8)],
        "puuid string, match_id string, played_at timestamp_ntz")
    docs = spark.createDataFrame([(f"M{i}", json.dumps({"i": i})) for i in range(8) if i != 6],
                                 "match_id string, match_details string")
    out = E.enrich(seeds, identity, history, docs, "t1", "t2", n=3).collect()
    # alice: latest three matches (M7, M6, M5); M6 has no document -> dropped.
    assert sorted(r.match_id for r in out) == ["M5", "M7"]
    assert {r.summonerId for r in out} == {"alice"}
    details = E.expand_history(E.resolve_identity(seeds, identity),
                               E.history_lists(history, 3), "t1").collect()
    assert [r.match_id for r in details] == ["M7", "M6", "M5"]


def test_recent_n_uses_a_partial_group_limit(spark):
    # one key ("p0") holds 999 of 1000 rows
    h = spark.range(1000).select(F.when(F.col("id") < 999, "p0").otherwise("p1").alias("puuid"),
                                 F.col("id").cast("string").alias("match_id"),
                                 F.timestamp_seconds("id").alias("played_at"))
    top = E.recent_n(h, 3).where(F.col("puuid") == "p0")
    assert [r.match_id for r in top.orderBy("recency").collect()] == ["998", "997", "996"]
    assert "WindowGroupLimit" in top._jdf.queryExecution().sparkPlan().toString()


def test_lookup_join_broadcasts_only_small_sides(spark):
    big = spark.range(100_000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan_text(lookup_join(big, small, "k"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan_text(lookup_join(big, small, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- trailing windows (W2, W3) -------------------------------------------------

def samples(spark, points):
    rows = [("m", {"s": s}, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=mnt), float(v))
            for s, mnt, v in points]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    return df.withColumn("s", F.col("labels")["s"])


def test_rate_counts_resets_single_samples_and_gaps(spark):
    pts = [("a", 0, 10), ("a", 10, 20), ("a", 20, 5), ("a", 30, 15),   # reset at minute 20
           ("b", 0, 7),                                               # a single sample
           ("c", 0, 1), ("c", 200, 50)]                               # gap > range
    r = {(x.s, x.ts.minute + 60 * x.ts.hour): round(x.rate, 9)
         for x in M.rate(samples(spark, pts), ["s"], 3600).collect()}
    assert r[("a", 30)] == round((10 + 5 + 10) / 3600, 9)
    assert r[("a", 20)] == round((10 + 5) / 3600, 9)
    assert r[("b", 0)] == 0.0
    assert r[("c", 200)] == 0.0


def test_delta_is_last_minus_first_in_range(spark):
    pts = [("a", 0, 10), ("a", 30, 40), ("a", 70, 100)]
    d = {x.ts.hour * 60 + x.ts.minute: x.delta
         for x in M.delta(samples(spark, pts), ["s"], 3600, per_s=60).collect()}
    assert d == {0: 0.0, 30: 30 / 60, 70: 60 / 60}


def test_bucketed_windows_equal_unbucketed(spark):
    pts = [(s, m, (m * 7 + len(s)) % 23) for s in ("a", "b") for m in range(0, 600, 13)]
    df = samples(spark, pts)

    def key(rows, col):
        return sorted((x.s, x.ts, round(x[col], 9)) for x in rows)
    one_bucket = M.rate(df, ["s"], 3600, bucket_s=86_400).collect()
    many = M.rate(df, ["s"], 3600, bucket_s=3600).collect()
    assert key(one_bucket, "rate") == key(many, "rate")
    assert key(M.delta(df, ["s"], 3600, 86_400).collect(), "delta") == \
        key(M.delta(df, ["s"], 3600, 3600).collect(), "delta")


def test_rate_goes_through_a_bucket_once(spark):
    """No frame slides (a dense range would be gone through once for each sample); restarts,
    ties and values that are not finite count in their own ranges only."""
    start = dt.datetime(2024, 1, 1)
    points = [(0, 1.0), (60, 5.0), (60, 4.0), (120, 2.0), (5000, float("inf")), (9000, 3.0),
              (9010, 4.0), (9020, 1.5), (13000, float("nan")), (13001, 7.0), (17000, 8.0),
              (30000, 1.0), (30010, 4.0), (30010, 4.0), (33610, 6.0)]    # a repeated first sample
    df = M.rate(spark.createDataFrame([("a", start + dt.timedelta(seconds=t), v) for t, v in points],
                                      "s string, ts timestamp_ntz, value double"), ["s"], 3600)
    assert "RangeFrame, -" not in plan_text(df)
    got = {}
    for r in df.collect():
        got.setdefault(int((r.ts - start).total_seconds()), []).append(str(round(r.rate * 3600, 9)))
    assert got == {0: ["0.0"], 60: ["4.0"] * 2, 120: ["6.0"], 5000: ["nan"], 9000: ["0.0"],
                   9010: ["1.0"], 9020: ["2.5"], 13000: ["nan"], 13001: ["nan"], 17000: ["0.0"],
                   30000: ["0.0"], 30010: ["3.0"] * 2, 33610: ["5.0"]}


# --- streams (T2, T7, S1) ------------------------------------------------------

def test_restarted_stream_adds_nothing(spark):
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("t-topic", "t-sink", "t-ckpt"))
    msgs = spark.createDataFrame(
        [(i, json.dumps({"timestamp_summoner": f"2024-01-01T00:00:0{i}", "match_details": {"i": i}}).encode())
         for i in range(6)], "key long, value binary")
    S.land_messages(msgs, topic, files=3)
    S.bronze_stream(spark, "files", topic, sink, ckpt, partition_date="2024-01-01", max_files=1)
    S.bronze_stream(spark, "files", topic, sink, ckpt, partition_date="2024-01-01", max_files=1)
    assert spark.read.parquet(sink).count() == 6


def test_kafka_options():
    o = S.kafka_options("broker:9092", "matchs", max_offsets=100, min_partitions=64)
    assert o["subscribe"] == "matchs" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "100"
    assert o["minPartitions"] == "64"


# --- privacy ---------------------------------------------------------------------

def test_k_anonymity_groups_nulls_and_drops_small_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "y"), (5, "y")], "id int, q string")
    assert sorted(r.id for r in P.k_anonymous(df, ["q"], 2).collect()) == [1, 2, 4, 5]


def test_published_stream_feeds_the_next_hop(spark):
    src, topic, sink = (fresh_path(spark, n) for n in ("p-src", "p-topic", "p-sink"))
    rows = spark.createDataFrame(
        [(i, json.dumps({"timestamp_summoner": "2024-01-01T00:00:00", "match_details": {"i": i}}).encode())
         for i in range(5)], "key long, value binary")
    S.land_messages(rows, src, files=2)
    S.run_split(S.read_messages(spark, "files", src, max_files=1),
                [S.Output(lambda b: b.rows, topic, "files")], fresh_path(spark, "p-ck1"))
    S.bronze_stream(spark, "files", topic, sink, fresh_path(spark, "p-ck2"), partition_date="2024-01-01")
    got = sorted(json.loads(r.match_details)["i"] for r in spark.read.parquet(sink).collect())
    assert got == [0, 1, 2, 3, 4]


def test_batch_publish_round_trips_rows_as_json(spark):
    from ingot.sources.sinks import as_messages, write_messages
    from ingot.functions.columns import parse_json
    rows = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 0, 0, 0, 123456))],
                                 "id long, name string, at timestamp_ntz")
    target = fresh_path(spark, "w-topic")
    write_messages(as_messages(rows, key_col="id"), "parquet", target)
    back = spark.read.parquet(target).select(
        F.col("key").cast("string").alias("key"),
        parse_json(F.col("value").cast("string"), "name string, at timestamp_ntz").alias("m")).first()
    assert back.key == "1" and back.m.name == "a" and back.m.at.microsecond == 123456


def test_enrichment_keeps_what_it_cannot_enrich(spark):
    seeds = spark.createDataFrame([("t0", "alice"), ("t0", "bob"), ("t0", "nobody")],
                                  "timestamp_summoner string, summonerId string")
    identity = spark.createDataFrame([("alice", "PA"), ("bob", "PB")], "summonerId string, puuid string")
    history = spark.createDataFrame(
        [("PA", f"M{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(8)],
        "puuid string, match_id string, played_at timestamp_ntz")
    docs = spark.createDataFrame([(f"M{i}", json.dumps({"i": i})) for i in range(8) if i != 6],
                                 "match_id string, match_details string")
    msgs, retries = E.enrich_with_retries(seeds, identity, history, docs, "t1", "t2", n=3)
    assert sorted(r.match_id for r in msgs.collect()) == ["M5", "M7"]
    assert sorted((r.summonerId, r.match_id, r.reason) for r in retries.collect()
                  if r.match_id) == [("alice", "M6", "no_document")]
    assert sorted((r.summonerId, r.reason) for r in retries.collect() if not r.match_id) == [
        ("bob", "no_history"), ("nobody", "unknown_player")]


def test_processing_time_trigger_runs_until_stopped(spark):
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("c-topic", "c-sink", "c-ckpt"))
    msgs = spark.createDataFrame(
        [(i, json.dumps({"timestamp_summoner": "2024-01-01T00:00:00", "match_details": {"i": i}}).encode())
         for i in range(6)], "key long, value binary")
    S.land_messages(msgs, topic, files=3)
    from ingot.operators.bronze import bronze_ingest
    stream = bronze_ingest(S.read_messages(spark, "files", topic, max_files=1), "2024-01-01")
    q = S.run_to_table(stream, sink, ckpt, available_now=False, processing_time="1 second",
                       files_per_batch=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(sink)
    assert out.count() == 6 and len(out.inputFiles()) <= 3


def test_grid_delta_needs_two_samples_in_the_window(spark):
    # samples at 00:00:30 (10), 00:02:30 (16), 00:09:30 (40); range 5 min, 1-minute grid
    pts = [("a", 0.5, 10), ("a", 2.5, 16), ("a", 9.5, 40)]
    rows = [("m", {"s": s}, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), float(v))
            for s, m, v in pts]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, "
                                     "value double").withColumn("s", F.col("labels")["s"])
    got = {r.t.minute: r.delta for r in M.delta_on_grid(df, ["s"], 300, 60).collect()}
    # grid times 00:03..00:05 hold both early samples; 00:10..00:14 hold one sample only
    assert got == {3: 6.0, 4: 6.0, 5: 6.0}


def test_delta_of_dense_and_tied_samples_is_that_of_the_sliding_frame(spark):
    """One pass over a bucket; ties, null values and times, and bucket ends included."""
    from pyspark.sql import Window
    from ingot.operators import metrics as M
    rows = [(s, None if i % 41 == 0 else i // 3 * 700, None if i % 17 == 0 else float(i * 37 % 101))
            for s in ("a", "b") for i in range(600)]
    samples = spark.createDataFrame(rows, "s string, at long, value double").withColumn(
        "ts", F.timestamp_seconds("at"))
    frame = Window.partitionBy("s", "_bucket").orderBy("_t").rangeBetween(-3600 * M.MICROS, 0)
    h = M.with_halo(samples, 3600)
    slid = h.withColumn("delta", F.col("value") - F.min(F.struct("_t", "value")).over(frame)["value"])
    want = sorted(map(repr, slid.where("_own").select("s", "at", "value", "delta").collect()))
    got = M.delta(samples, ["s"], 3600)
    assert sorted(map(repr, got.select("s", "at", "value", "delta").collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame" not in plan


def test_documents_are_joined_narrow_and_computed_once(spark):
    """Lines are shuffled as they are, once, also where every third document lands twice."""
    from ingot.sources import fixtures as X
    twice = X.landed_twice(X.match_documents(spark, "/root/testdata/sf0.001"))
    plan = twice._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("collect_list(struct(l_partkey") == 2          # partial and final
    assert plan.count("StructsToJson") + plan.count("to_json") >= 1
    keys = [r.o_orderkey for r in twice.select("o_orderkey").collect()]
    orders = [r.o_orderkey for r in spark.read.parquet("/root/testdata/sf0.001/orders.parquet").collect()]
    assert sorted(keys) == sorted(orders + [k for k in orders if k % 3 == 0])


def test_a_hop_writes_the_files_the_next_one_takes_at_once(spark, monkeypatch):
    """Files of a hop's topic do not grow with the shuffle partitions."""
    from ingot.plans import enrich as P
    from ingot.session import list_names
    at, run = {}, P.run_hops
    monkeypatch.setattr(P, "run_hops", lambda *a: at.update(run(*a)) or at)
    P.q_enrich_stream(spark, "/root/testdata/sf0.001")
    for topic in ("details", "matchs"):
        batches = [n for n in list_names(spark, at[topic]) if n.startswith("batch=")]
        files = [n for b in batches for n in list_names(spark, f"{at[topic]}/{b}") if n.endswith(".parquet")]
        assert len(batches) == 1 and 0 < len(files) <= P.BATCH_FILES
