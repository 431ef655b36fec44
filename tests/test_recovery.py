"""Re-driving retries, and a date's tables published together."""

import datetime as dt
import json

import pytest

from ingot import jobs
from ingot.operators import documents as D
from ingot.operators import monitor as T
from ingot.operators import retry as R
from ingot.plans.silver import run_bronze_to_silver, run_silver_to_gold
from ingot.session import fresh_path
from ingot.sources.sinks import overwrite_partitions, publish_version
from ingot.sources.tables import read_layer_if_present
from test_semantics import DAY1, bronze_rows, document, participant

RETRY = ("timestamp_summoner string, summonerId string, match_id string, reason string, "
         "partition_date date")
DAY = dt.date(2024, 2, 1)


def table(spark, name, rows, schema, key):
    return publish_version(spark.createDataFrame(rows, schema), key, name, fresh_path(spark, name), 2)


def states(spark, path):
    return {r.summonerId: (r.status, r.attempts, r.reason) for r in R.known_states(spark, path)[1].collect()}


def values(spark, path):
    return [json.loads(bytes(r.value)) for r in spark.read.parquet(path).collect()]


def test_redriving_the_first_hop(spark):
    retry, state, sink, dead = (fresh_path(spark, f"rd-{n}") for n in ("retry", "state", "sink", "dead"))
    asked = [("t", n, None, "unknown_player", DAY) for n in ("late", "never", "late")]
    spark.createDataFrame(asked, RETRY).write.partitionBy("partition_date").parquet(retry)
    table(spark, "rd_identity", [("nobody", "P0")], "summonerId string, puuid string", "summonerId")
    table(spark, "rd_history", [("P1", ["M1", "M2"])], "puuid string, match_ids array<string>", "puuid")

    def run(at, *more):
        jobs.main(["redrive-details", retry, state, "rd_identity", "rd_history", sink, dead, "--at",
                   f"2024-02-01T{at}", "--max-attempts", "3", "--backoff", "600", *more], spark=spark)
    run("10:00:00")                                        # second try of both
    assert states(spark, state) == {"late": ("waiting", 2, "unknown_player"),
                                    "never": ("waiting", 2, "unknown_player")}
    table(spark, "rd_identity", [("late", "P1")], "summonerId string, puuid string", "summonerId")
    run("10:05:00")                                        # not due yet
    assert states(spark, state)["late"] == ("waiting", 2, "unknown_player")
    run("10:20:01")                                        # 600 s doubled: due
    assert states(spark, state) == {"late": ("sent", 3, "unknown_player"),
                                    "never": ("dead", 3, "unknown_player")}
    assert sorted(v["match_id"] for v in values(spark, sink)) == ["M1", "M2"]
    run("23:00:00")                                        # nothing left: nothing sent twice
    assert len(values(spark, sink)) == 2
    assert [(r.summonerId, r.attempts) for r in spark.read.parquet(dead).collect()] == [("never", 3)]


def test_a_run_that_failed_is_repeated_under_its_number(spark, monkeypatch):
    retry, state, sink, dead = (fresh_path(spark, f"rf-{n}") for n in ("retry", "state", "sink", "dead"))
    spark.createDataFrame([("t", "a", "M1", "no_document", DAY)], RETRY).write.partitionBy(
        "partition_date").parquet(retry)
    table(spark, "rf_documents", [("M1", "{}")], "match_id string, match_details string", "match_id")
    args = ["redrive-matches", retry, state, "rf_documents", sink, dead, "--at", "2024-02-01T10:00:00"]
    enriched = R.E.enriched
    monkeypatch.setattr(R.F, "max", lambda *a: 1 / 0)      # dies once the messages are out
    with pytest.raises(ZeroDivisionError):
        jobs.main(args, spark=spark)
    monkeypatch.undo()
    assert R.E.enriched is enriched and R.known_states(spark, state)[0] == 0
    assert len(values(spark, sink)) == 1
    jobs.main(args, spark=spark)
    (sent,) = values(spark, sink)
    assert sent["match_id"] == "M1" and sent["timestamp_summoner_details"] == "2024-02-01T10:00:00.000000"
    assert states(spark, state) == {"a": ("sent", 2, "no_document")}


def test_what_landed_meanwhile_is_not_sent_again(spark):
    retry, state, sink, dead, landed = (fresh_path(spark, f"rl-{n}") for n in (
        "retry", "state", "sink", "dead", "landed"))
    spark.createDataFrame([("t", "a", "M1", "no_document", DAY), ("t", "b", "M2", "no_document", DAY)],
                          RETRY).write.partitionBy("partition_date").parquet(retry)
    spark.createDataFrame([("M1",), ("M1",)], "match_id string").write.parquet(landed)
    table(spark, "rl_documents", [("M1", "{}"), ("M2", "{}")], "match_id string, match_details string",
          "match_id")
    jobs.main(["redrive-matches", retry, state, "rl_documents", sink, dead, "--landed", landed], spark=spark)
    assert [v["match_id"] for v in values(spark, sink)] == ["M2"]
    assert {k: v[:2] for k, v in states(spark, state).items()} == {"a": ("landed", 1), "b": ("sent", 2)}


# A date's tables

def daily(spark):
    bronze = fresh_path(spark, "pub-bronze")
    silver = {k: fresh_path(spark, f"pub-{k}") for k in ("games", "participants", "teams_stats", "teams_bans")}
    gold = {k: fresh_path(spark, f"pub-{k}") for k in ("match_summary", "player_performance", "team_performance")}
    return bronze, silver, gold


def test_a_failure_after_the_second_table_leaves_the_old_date_whole(spark, monkeypatch):
    bronze, silver, gold = daily(spark)
    teams = [{"teamId": 100, "win": True, "objectives": {"baron": {"kills": 1}}, "bans": []}]
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)], teams)]), bronze)
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)

    def everything():
        out = {}
        for name, path in {**silver, **gold}.items():
            rows = read_layer_if_present(spark, path, DAY1)
            out[name] = sorted(map(repr, rows.collect())) if rows is not None else []
        return out
    before = everything()
    overwrite_partitions(bronze_rows(spark, [document(2, [participant(2), participant(3)], teams)]), bronze)
    stats = D.team_stats
    monkeypatch.setattr(D, "team_stats", lambda docs: stats(docs).selectExpr(
        "*", "raise_error('third table') AS oops"))
    with pytest.raises(Exception, match="third table"):
        run_bronze_to_silver(spark, bronze, silver, DAY1)
    monkeypatch.undo()
    run_silver_to_gold(spark, silver, gold, DAY1)
    assert everything() == before                          # the old date, in all tables
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)
    assert [r.match_id for r in spark.read.parquet(silver["games"]).collect()] == [2]
    assert spark.read.parquet(gold["player_performance"]).count() == 2


def test_gold_reads_published_dates_only(spark, monkeypatch):
    bronze, silver, gold = daily(spark)
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)])]), bronze)
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    from ingot.sources import sinks
    dropped = []

    def stop(spark, path, date, *a):
        dropped.append(path)
        if len(dropped) == 3:
            raise OSError("lost the storage")
        real(spark, path, date, *a)
    real = sinks.drop_partition
    monkeypatch.setattr(sinks, "drop_partition", stop)
    with pytest.raises(OSError, match="storage"):
        run_bronze_to_silver(spark, bronze, silver, DAY1)  # stops while directories are swapped
    monkeypatch.undo()
    with pytest.raises(ValueError, match="not published"):
        run_silver_to_gold(spark, silver, gold, DAY1)
    run_bronze_to_silver(spark, bronze, silver, DAY1)
    run_silver_to_gold(spark, silver, gold, DAY1)
    assert spark.read.parquet(gold["match_summary"]).count() == 1


# Latency sketches

def test_merged_sketches_stay_within_their_rank_error(spark):
    rows = [(f"2024-01-01T{i % 3:02}:{i % 60:02}:00", f"2024-01-01T{i % 3:02}:{i % 60:02}:{i % 59:02}.{i:06}", None)
            for i in range(6000)]
    bronze = spark.createDataFrame(rows, "timestamp_summoner string, timestamp_summoner_details string, "
                                         "timestamp_match string")
    shares = {f"p{s}": s / 100 for s in (1, 50, 95, 99)}
    sketches = T.latency_sketches(bronze)
    assert sketches.count() == 60
    for unit, n in (("hour", 3), ("day", 1)):
        errors = T.rank_errors(bronze, T.merge_sketches(sketches, unit, shares), unit, shares).collect()
        assert len(errors) == n and sum(r.n for r in errors) == 6000
        assert all(r[name] <= 0.01 for r in errors for name in shares)
