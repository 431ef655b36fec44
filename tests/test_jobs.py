"""The command-line jobs, driven in-process with the test session."""

import datetime as dt
import json

import pytest

from ingot import jobs
from ingot.session import fresh_path
from ingot.sources.sinks import overwrite_partitions
from ingot.streaming import ingest as S
from test_semantics import DAY1, bronze_rows, document, participant


def test_daily_jobs_from_the_command_line(spark):
    bronze = fresh_path(spark, "j-bronze")
    overwrite_partitions(bronze_rows(spark, [document(5, [participant(2, kills=3),
                                                          participant(1, kills=1)])]), bronze)
    silver = [fresh_path(spark, f"j-{k}") for k in ("g", "p", "ts", "tb")]
    gold = [fresh_path(spark, f"j-{k}") for k in ("ms", "pp", "tp")]
    jobs.main(["bronze-to-silver", bronze, *silver, str(DAY1)], spark=spark)
    jobs.main(["silver-to-gold", *silver, *gold, str(DAY1)], spark=spark)
    perf = sorted((r.participant_id, r.total_kills, r.partition_date)
                  for r in spark.read.parquet(gold[1]).collect())
    assert perf == [(1, 1, DAY1), (2, 3, DAY1)]


def test_ingest_job_from_files(spark):
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("j-topic", "j-sink", "j-ckpt"))
    msgs = spark.createDataFrame(
        [(i, json.dumps({"timestamp_summoner": "2024-01-01T00:00:00", "match_details": {"i": i}}).encode())
         for i in range(4)], "key long, value binary")
    S.land_messages(msgs, topic, files=2)
    jobs.main(["ingest", sink, ckpt, "--files", topic, "--date", "2024-01-02",
               "--max-per-trigger", "1"], spark=spark)
    rows = spark.read.parquet(sink).collect()
    assert len(rows) == 4 and {r.partition_date for r in rows} == {dt.date(2024, 1, 2)}


def test_rerun_with_empty_branch_leaves_no_stale_rows(spark):
    from ingot.plans.silver import run_bronze_to_silver, run_silver_to_gold
    teams = [{"teamId": 100, "win": True, "objectives": {"baron": {"kills": 1}}, "bans": []}]
    bronze = fresh_path(spark, "e-bronze")
    silver = {k: fresh_path(spark, f"e-{k}") for k in ("games", "participants", "teams_stats", "teams_bans")}
    gold = {k: fresh_path(spark, f"e-{k}") for k in ("match_summary", "player_performance", "team_performance")}
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)], teams)]), bronze)
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)
    assert spark.read.parquet(gold["team_performance"]).count() == 1
    # the date is reloaded, now without teams: team tables must lose that date
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)])]), bronze)
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)
    from ingot.sources.tables import read_layer_if_present
    for path in (silver["teams_stats"], gold["team_performance"]):
        left = read_layer_if_present(spark, path, DAY1)
        assert left is None or left.count() == 0
    assert spark.read.parquet(gold["player_performance"]).count() == 1


def test_quarantine_rides_the_single_pass(spark):
    from ingot.plans.silver import run_bronze_to_silver
    bronze = fresh_path(spark, "qq-bronze")
    silver = {"games": fresh_path(spark, "qq-games")}
    quarantine = fresh_path(spark, "qq-quarantine")
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)]), "garbage", "garbage",
                                             "{other garbage"]), bronze)
    run_bronze_to_silver(spark, bronze, silver, DAY1, quarantine_path=quarantine)
    assert sorted(r.match_details for r in spark.read.parquet(quarantine).collect()) == [
        "garbage", "garbage", "{other garbage"]
    assert [r.match_id for r in spark.read.parquet(silver["games"]).collect()] == [1]


def test_every_message_lands_once(spark):
    """Good, garbage, null, blank and repeated messages: bronze + quarantine = sent."""
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("q-topic", "q-sink", "q-ckpt"))
    good = json.dumps({"timestamp_summoner": "2024-01-01T00:00:00"}).encode()
    values = [good, good, b"{cut", b"{cut", None, b"", b"  ", b'{"a":1}']
    S.land_messages(spark.createDataFrame(list(enumerate(values)), "key long, value binary"), topic,
                    files=3)
    args = ["ingest", sink, ckpt, "--files", topic, "--date", "2024-01-02", "--max-per-trigger", "1"]
    jobs.main(args, spark=spark)
    jobs.main(args, spark=spark)                       # nothing new: nothing more lands
    assert spark.read.parquet(sink).count() == 3
    bad = spark.read.parquet(f"{sink}_quarantine").collect()
    assert sorted(repr(r.raw_message) for r in bad) == [
        "'  '", "''", "'{cut'", "'{cut'", "None"]


def test_null_and_empty_documents_never_reach_silver(spark):
    from ingot.plans.silver import run_bronze_to_silver
    bronze, games = fresh_path(spark, "n-bronze"), fresh_path(spark, "n-games")
    from pyspark.sql import functions as F
    rows = bronze_rows(spark, [document(1, [participant(1)]), "", "{}"])
    nulls = bronze_rows(spark, ["x", "y"]).withColumn("match_details", F.lit(None).cast("string"))
    overwrite_partitions(rows.unionByName(nulls), bronze)
    run_bronze_to_silver(spark, bronze, {"games": games}, DAY1)
    assert [r.match_id for r in spark.read.parquet(games).collect()] == [1]
    bad = spark.read.parquet(f"{games}_quarantine").collect()
    assert sorted(repr(r.match_details) for r in bad) == ["''", "'{}'", "None", "None"]


def test_missing_silver_root_is_an_error_and_keeps_gold(spark):
    from ingot.plans.silver import run_silver_to_gold
    gold = {"match_summary": fresh_path(spark, "m-gold")}
    overwrite_partitions(spark.createDataFrame([(1, DAY1)], "match_id long, partition_date date"),
                         gold["match_summary"])
    with pytest.raises(FileNotFoundError):
        run_silver_to_gold(spark, {"games": fresh_path(spark, "m-nowhere")}, gold, DAY1)
    assert spark.read.parquet(gold["match_summary"]).count() == 1


def test_daily_job_leaves_no_scratch(spark):
    import os

    from ingot.plans.silver import run_bronze_to_silver
    from ingot.session import shared_root
    bronze, games = fresh_path(spark, "s-bronze"), fresh_path(spark, "s-games")
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)])]), bronze)
    run_bronze_to_silver(spark, bronze, {"games": games}, DAY1)
    root = shared_root(spark).removeprefix("file://")
    assert not [n for n in os.listdir(root) if n.startswith("silver-input")]


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from ingot import session
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_OWN_ROOTS", {})
    monkeypatch.setattr(session, "_configured", lambda spark: None)
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_root(spark)


def test_enrichment_jobs_end_to_end(spark):
    """publish-seeds -> enrich-details -> enrich-matches -> ingest, with every kind of miss."""
    at = {k: fresh_path(spark, f"en-{k}") for k in (
        "snap", "seeds", "details", "matchs", "bronze", "r1", "r2", "q1", "q2", "c1", "c2", "c3",
        "idsrc", "histsrc", "docsrc", "idt", "histt", "doct")}
    spark.createDataFrame([([("alice",), ("bob",), ("nobody",)],)],
                          "entries array<struct<summonerId:string>>").write.json(at["snap"])
    spark.createDataFrame([("alice", "PA"), ("bob", "PB")], "summonerId string, puuid string"
                          ).write.parquet(at["idsrc"])
    spark.createDataFrame([("PA", f"M{i}", dt.datetime(2024, 1, 1, i)) for i in range(8)],
                          "puuid string, match_id string, played_at timestamp_ntz"
                          ).write.parquet(at["histsrc"])
    spark.createDataFrame([(f"M{i}", json.dumps({"i": i})) for i in range(8) if i != 6],
                          "match_id string, match_details string").write.parquet(at["docsrc"])
    run = lambda *a: jobs.main(list(a), spark=spark)
    run("refresh-lookup", at["idsrc"], "summonerId", "en_identity", at["idt"], "--buckets", "2")
    run("refresh-lookup", at["histsrc"], "puuid", "en_history", at["histt"], "--buckets", "2",
        "--latest", "3")
    run("refresh-lookup", at["docsrc"], "match_id", "en_documents", at["doct"], "--buckets", "2")
    run("publish-seeds", at["snap"], at["seeds"], "--taken-at", "2024-02-01T00:00:00")
    S.land_messages(spark.createDataFrame([(9, b"{broken")], "key long, value binary"), at["seeds"],
                    files=1)
    run("enrich-details", "en_identity", "en_history", at["details"], at["r1"], at["q1"], at["c1"],
        "--files", at["seeds"], "--date", "2024-02-01")
    run("enrich-matches", "en_documents", at["matchs"], at["r2"], at["q2"], at["c2"], "--files",
        at["details"], "--date", "2024-02-01")
    run("ingest", at["bronze"], at["c3"], "--files", at["matchs"], "--date", "2024-02-01")
    rows = spark.read.parquet(at["bronze"]).collect()
    assert sorted(json.loads(r.match_details)["i"] for r in rows) == [5, 7]
    missed = spark.read.parquet(at["r1"]).union(spark.read.parquet(at["r2"])).collect()
    assert sorted((r.summonerId, r.reason) for r in missed) == [
        ("alice", "no_document"), ("bob", "no_history"), ("nobody", "unknown_player")]
    assert [r.raw_message for r in spark.read.parquet(at["q1"]).collect()] == ["{broken"]


def test_throughput_and_retention_jobs(spark):
    bronze, sink = fresh_path(spark, "tr-bronze"), fresh_path(spark, "tr-sink")
    rows = [("2024-01-01T00:00:10", "2024-01-01T00:00:20", None, "{}", dt.date(2024, 1, d))
            for d in (1, 2, 3)]
    overwrite_partitions(spark.createDataFrame(
        rows, "timestamp_summoner string, timestamp_summoner_details string, timestamp_match string, "
              "match_details string, partition_date date"), bronze)
    for date in ("2024-01-01", "2024-01-02"):          # one date after the other: both stay
        jobs.main(["throughput", bronze, sink, date], spark=spark)
    jobs.main(["throughput", bronze, sink, "2024-01-01"], spark=spark)
    rows = spark.read.parquet(sink).collect()
    assert {str(r.partition_date): (r.summoner, r.summoner_details, r.match) for r in rows} == {
        "2024-01-01": (1, 1, 0), "2024-01-02": (1, 1, 0)} and len(rows) == 2
    jobs.main(["throughput", bronze, sink], spark=spark)
    assert sorted(str(r.partition_date) for r in spark.read.parquet(sink).collect()) == [
        "2024-01-01", "2024-01-02", "2024-01-03"]
    jobs.main(["retention", bronze, "2024-01-02"], spark=spark)
    assert {str(r.partition_date) for r in spark.read.parquet(bronze).collect()} == {
        "2024-01-02", "2024-01-03"}
    with pytest.raises(FileNotFoundError):
        jobs.main(["retention", fresh_path(spark, "tr-none"), "2024-01-02"], spark=spark)


def test_metric_reader_prunes_days(spark):
    from ingot.sources.tables import read_samples
    path = fresh_path(spark, "samples")
    rows = [("m", {"a": "b"}, dt.datetime(2024, 1, d, 12), float(d), dt.date(2024, 1, d))
            for d in range(1, 6)]
    spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double, "
                                "day date").write.partitionBy("day").parquet(path)
    df = read_samples(spark, path, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4, 23))
    assert sorted(r.value for r in df.collect()) == [3.0, 4.0]
    assert df.columns == ["metric", "labels", "ts", "value"]
    assert "PartitionFilters: [" in df._jdf.queryExecution().executedPlan().toString()


def test_ingest_lands_each_key_once_and_keeps_late_rows(spark):
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("d-topic", "d-sink", "d-ckpt"))

    def land(*rows):
        S.land_messages(spark.createDataFrame(
            [(k, t and json.dumps({"timestamp_summoner": t}).encode()) for k, t in rows],
            "key long, value binary"), topic, files=1)
        jobs.main(["ingest", sink, ckpt, "--files", topic, "--date", "2024-01-02", "--dedupe", "3600"],
                  spark=spark)
    land((1, "2024-01-01T10:00:00"), (1, "2024-01-01T10:00:00"), (2, "2024-01-01T12:00:00"))
    land((2, "2024-01-01T12:00:00"),       # repeated inside the delay: recognised
         (1, "2024-01-01T10:00:00"),       # repeated outside: late
         (3, "2024-01-01T01:00:00"),       # never seen, eleven hours late: kept as late
         (4, "2024-01-01T12:30:00"), (5, None), (6, "no time"))
    key = lambda path: sorted(int(r.key) for r in spark.read.parquet(path).collect())
    assert key(sink) == [1, 2, 4]
    assert key(f"{sink}_late") == [1, 3, 6]
    assert key(f"{sink}_quarantine") == [5]


def test_ingest_with_dedupe_lands_every_message_without_a_key(spark):
    topic, sink, ckpt = (fresh_path(spark, n) for n in ("u-topic", "u-sink", "u-ckpt"))

    def land(*rows):
        S.land_messages(spark.createDataFrame(
            [(k, json.dumps({"timestamp_summoner": t}).encode()) for k, t in rows],
            "key long, value binary"), topic, files=1)
        jobs.main(["ingest", sink, ckpt, "--files", topic, "--date", "2024-01-02", "--dedupe", "3600"],
                  spark=spark)
    land((None, "2024-01-01T10:00:00"), (None, "2024-01-01T10:01:00"), (1, "2024-01-01T10:02:00"),
         (1, "2024-01-01T10:02:00"))
    land((None, "2024-01-01T10:03:00"), (None, "2024-01-01T10:03:00"), (1, "2024-01-01T10:02:00"),
         (None, "2024-01-01T01:00:00"))
    landed = spark.read.parquet(sink).collect()
    assert sorted(r.timestamp_summoner[11:16] for r in landed if r.key is None) == [
        "10:00", "10:01", "10:03", "10:03"]
    assert [bytes(r.key) for r in landed if r.key is not None] == [b"1"]
    assert [r.key for r in spark.read.parquet(f"{sink}_late").collect()] == [None]


def test_daily_jobs_shuffle_neither_documents_nor_silver_rows(spark, monkeypatch):
    """Documents, and the rows that gold rolls up, are grouped where they lie, in buckets of
    their match; what is written for that is gone at the end."""
    import os
    from ingot.operators import documents as D
    from ingot.operators import rollups as R
    from ingot.plans.silver import run_bronze_to_silver, run_silver_to_gold
    from ingot.session import shared_root
    plans = {}

    def watch(module, name):
        plain = getattr(module, name)

        def watched(*args, **kw):
            out = plain(*args, **kw)
            plans[name] = out._jdf.queryExecution().executedPlan().toString()
            return out
        monkeypatch.setattr(module, name, watched)
    for module, name in ((D, "dedupe_by_key"), (R, "match_summary"), (R, "player_performance"),
                         (R, "team_performance")):
        watch(module, name)
    bronze = fresh_path(spark, "ns-bronze")
    silver = {k: fresh_path(spark, f"ns-{k}") for k in ("games", "participants", "teams_stats", "teams_bans")}
    gold = {k: fresh_path(spark, f"ns-{k}") for k in ("match_summary", "player_performance", "team_performance")}
    teams = [{"teamId": 100, "win": True, "objectives": {"baron": {"kills": 1}}, "bans": []}]
    docs = [document(i, [participant(1, kills=i), participant(2)], teams) for i in range(40)]
    again = [document(i, [participant(1, kills=i + 50)], teams) for i in range(0, 40, 4)]
    overwrite_partitions(bronze_rows(spark, [*docs, *again, *docs[:7], "bad", "bad", "{cut", None]), bronze)
    before = spark.catalog.listTables()
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)
    assert set(plans) == {"dedupe_by_key", "match_summary", "player_performance", "team_performance"}
    for name, plan in plans.items():
        assert "Exchange" not in plan and "Bucketed: true" in plan, name
    assert spark.catalog.listTables() == before
    root = shared_root(spark).removeprefix("file://").removeprefix("file:")
    assert not [n for n in os.listdir(root) if n.startswith("clustered-")]
    bad = spark.read.parquet(f"{silver['games']}_quarantine").collect()
    assert sorted(r.match_details for r in bad) == ["bad", "bad", "null", "{cut"]
    perf = spark.read.parquet(gold["player_performance"]).collect()
    # Equal stage times: the greater document survives.
    most = {i: max([docs[i], *([again[i // 4]] if i % 4 == 0 else [])],
                   key=lambda d: [p["kills"] for p in d["info"]["participants"]])
            for i in range(40)}
    want = [(i, p["kills"]) for i, d in most.items() for p in d["info"]["participants"]]
    assert sorted((r.match_id, r.total_kills) for r in perf) == sorted(want)
    assert sorted(r.match_id for r in spark.read.parquet(gold["match_summary"]).collect()) == list(range(40))
    assert spark.read.parquet(gold["team_performance"]).count() == 40


def test_what_is_clustered_goes_also_after_a_failure(spark):
    from ingot.session import path_exists
    from ingot.sources.sinks import clustered
    rows = spark.range(50).selectExpr("id % 7 AS k", "id")
    with pytest.raises(ZeroDivisionError):
        with clustered(rows, "k", "failing", 3, False) as here:
            assert here.count() == 50
            folder = here.inputFiles()[0].rpartition("/")[0]
            1 / 0
    assert not path_exists(spark, folder)
    assert not [t for t in spark.catalog.listTables() if "failing" in t.name]


def test_files_of_buckets_grow_no_faster_than_the_rows(spark):
    from ingot.sources.sinks import ROWS_PER_BUCKET_FILE, bucket_layout
    for n in (0, 1, 1000, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9, 10 ** 11):
        buckets, gather = bucket_layout(spark, n, 250_000)
        assert buckets >= 1 and buckets * 250_000 >= n
        assert gather or buckets ** 2 <= max(1, n // ROWS_PER_BUCKET_FILE)
    assert bucket_layout(spark, 72_000_000, 250_000) == (288, False)
    assert bucket_layout(spark, 10 ** 9, 250_000) == (4000, True)


def test_surviving_documents_are_joined_by_bucket(spark, monkeypatch):
    """Also where the list of survivors is too large to be broadcast."""
    from ingot.plans import silver as P
    bronze, games, teams = (fresh_path(spark, n) for n in ("sb-bronze", "sb-games", "sb-teams"))
    docs = [document(i % 30, [participant(1, kills=i)]) for i in range(45)]
    overwrite_partitions(bronze_rows(spark, [*docs, "bad", "bad"]), bronze)
    plans, plain = [], P.replace_dates

    def replace_dates(outputs, date):
        plans.extend(f._jdf.queryExecution().executedPlan().toString() for f in outputs.values())
        plain(outputs, date)
    monkeypatch.setattr(P, "replace_dates", replace_dates)
    monkeypatch.setattr(P, "bucket_layout", lambda *a: (3, False))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        P.run_bronze_to_silver(spark, bronze, {"games": games, "teams_stats": teams}, DAY1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 3
    for plan in plans:
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(r.match_id for r in spark.read.parquet(games).collect()) == list(range(30))
    assert spark.read.parquet(f"{games}_quarantine").count() == 2
