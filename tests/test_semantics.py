
import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ingot.functions.schemas import BRONZE_COLUMNS
from ingot.operators import documents as D
from ingot.operators import monitor as T
from ingot.operators import rollups as R
from ingot.operators.bronze import bronze_ingest, parse_envelope, quarantined
from ingot.plans.silver import run_bronze_to_silver
from ingot.session import fresh_path
from ingot.sources.sinks import overwrite_partitions

DAY1, DAY2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def participant(champ, team=100, kills=1, win=True, **kw):
    p = {"championId": champ, "championName": f"C{champ}", "teamId": team,
         "kills": kills, "deaths": 2, "assists": 3, "win": win}
    p.update(kw)
    return p


def document(game_id, parts, teams=None):
    return {"metadata": {"matchId": f"BR1_{game_id}", "participants": [f"P{i}" for i in range(len(parts))]},
            "info": {"gameId": game_id, "gameMode": "CLASSIC", "participants": parts,
                     "teams": teams or []}}


def bronze_rows(spark, docs, day=DAY1, stamps=("2024-03-01T10:00:00.000000",) * 3):
    rows = [(stamps[0], stamps[1], stamps[2], d if isinstance(d, str) else json.dumps(d), day)
            for d in docs]
    schema = "timestamp_summoner string, timestamp_summoner_details string, " \
             "timestamp_match string, match_details string, partition_date date"
    return spark.createDataFrame(rows, schema)


def messages(spark, texts):
    return spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "key long, value binary")


def test_q1_nested_object_lands_as_text(spark):
    msg = json.dumps({"timestamp_summoner": "2024-03-01T10:00:00", "match_details": {"a": {"b": 1}}})
    row = bronze_ingest(messages(spark, [msg]), DAY1).first()
    assert json.loads(row.match_details) == {"a": {"b": 1}}
    assert row.partition_date == DAY1


def test_q2_win_is_a_string_and_max_acts_as_or(spark):
    doc = document(1, [participant(1, win=True), participant(2, win=False),
                       participant(3, team=200, win=False)])
    parts = D.participants(D.silver_input(bronze_rows(spark, [doc])))
    assert {r.win for r in parts.collect()} == {"true", "false"}
    team = parts.groupBy("team_id").agg(F.max("win").alias("w"))
    assert {r.team_id: r.w for r in team.collect()} == {100: "true", 200: "false"}


def test_q3_duplicate_documents_do_not_renumber(spark):
    doc = document(7, [participant(c) for c in (5, 3, 9, 1, 4)])
    b = bronze_rows(spark, [doc, doc, doc])
    parts = D.participants(D.silver_input(b))
    assert sorted(r.participant_id for r in parts.collect()) == [1, 2, 3, 4, 5]
    perf = R.player_performance(parts)
    assert perf.count() == 5


def test_q4_ties_on_champion_get_stable_ids(spark):
    doc_a = document(8, [participant(5, kills=9), participant(5, kills=1), participant(2)])
    doc_b = document(8, [participant(2), participant(5, kills=1), participant(5, kills=9)])
    ids = []
    for doc in (doc_a, doc_b):
        p = D.participants(D.silver_input(bronze_rows(spark, [doc])))
        ids.append(sorted((r.participant_id, r.champion_id, r.kills) for r in p.collect()))
    assert ids[0] == ids[1] == [(1, 2, 1), (2, 5, 1), (3, 5, 9)]
    w = D.participants_by_window(D.silver_input(bronze_rows(spark, [doc_a])))
    assert sorted((r.participant_id, r.champion_id, r.kills) for r in w.collect()) == ids[0]


def test_q5_q6_rerun_replaces_one_date_and_keeps_input_date(spark):
    bronze = fresh_path(spark, "t-bronze")
    out = {k: fresh_path(spark, f"t-{k}") for k in ("games", "participants", "teams_stats", "teams_bans")}
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)])], DAY1), bronze)
    overwrite_partitions(bronze_rows(spark, [document(2, [participant(1), participant(2)])], DAY2), bronze)
    run_bronze_to_silver(spark, bronze, out, DAY1)
    run_bronze_to_silver(spark, bronze, out, DAY2)
    run_bronze_to_silver(spark, bronze, out, DAY2)   # rerun: same table
    games = spark.read.parquet(out["games"])
    assert sorted((r.match_id, r.partition_date) for r in games.collect()) == [(1, DAY1), (2, DAY2)]
    assert spark.read.parquet(out["participants"]).count() == 3


def test_q7_garbage_envelope_and_garbage_document_are_quarantined(spark):
    good = json.dumps({"timestamp_summoner": "2024-03-01T10:00:00",
                       "match_details": document(3, [participant(1)])})
    bad_doc = json.dumps({"timestamp_summoner": "2024-03-01T10:00:00", "match_details": "not json"})
    env = parse_envelope(messages(spark, [good, "{garbage", bad_doc]), keep=("key",))
    q = quarantined(env, DAY1, keep=("key",)).collect()
    assert [r.key for r in q] == [1] and q[0].raw_message == "{garbage"
    ok, bad = D.split_by_key(D.with_match_key(bronze_ingest(
        messages(spark, [good, "{garbage", bad_doc]), DAY1)))
    assert ok.count() == 1 and bad.count() == 1


def test_q8_bad_field_nulls_only_that_field(spark):
    doc = document(4, [{"championId": "abc", "kills": 7}])
    p = D.participants(D.silver_input(bronze_rows(spark, [doc]))).first()
    assert p.champion_id is None and p.kills == 7


def test_q9_q10_null_and_malformed_stage_times_are_not_counted(spark):
    rows = [("2024-03-01T10:00:01", "2024-03-01T10:00:30", None, "{}", DAY1),
            ("2024-03-01T10:00:02", "garbage", "2024-03-01T10:01:00", "{}", DAY1)]
    b = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLUMNS[:4])
                              + ", partition_date date")
    got = {(str(r.minute), r.summoner, r.summoner_details, r.match)
           for r in T.stage_throughput(b).collect()}
    assert got == {("2024-03-01 10:00:00", 2, 1, 0), ("2024-03-01 10:01:00", 0, 0, 1)}
    assert T.stage_throughput_join(b).collect() == T.stage_throughput(b).collect()


def test_q11_one_seed_with_five_matches_counts_five_times(spark):
    rows = [("2024-03-01T10:00:00", "2024-03-01T10:00:05", f"2024-03-01T10:0{i}:30", "{}", DAY1)
            for i in range(5)]
    b = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLUMNS[:4])
                              + ", partition_date date")
    first = T.stage_throughput(b).first()
    assert first.summoner == 5 and first.summoner_details == 5


def test_parse_schema_has_no_extra_fields(spark):
    schema = StructType([StructField("x", StringType())])
    assert D.document_schema(["gameId"]).fieldNames() == ["info"]
    assert schema.fieldNames() == ["x"]


def test_q11_distinct_variant_counts_the_seed_once(spark):
    rows = [("2024-03-01T10:00:00", "2024-03-01T10:00:05", f"2024-03-01T10:0{i}:30", "{}", DAY1)
            for i in range(5)]
    b = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLUMNS[:4])
                              + ", partition_date date")
    first = T.stage_throughput_distinct(b).first()
    assert first.summoner == 1 and first.summoner_details == 1 and first.match == 1


def test_daily_jobs_bronze_to_gold_keep_dates_and_quarantine(spark):
    from ingot.plans.silver import run_silver_to_gold
    bronze = fresh_path(spark, "d-bronze")
    silver = {k: fresh_path(spark, f"d-{k}") for k in ("games", "participants", "teams_stats", "teams_bans")}
    gold = {k: fresh_path(spark, f"d-{k}") for k in ("match_summary", "player_performance", "team_performance")}
    quarantine = fresh_path(spark, "d-quarantine")
    teams = [{"teamId": 100, "win": True, "objectives": {"baron": {"kills": 1}, "dragon": {"kills": 2},
                                                         "tower": {"kills": 3}},
              "bans": [{"pickTurn": 1, "championId": 7}]}]
    doc1 = document(1, [participant(3, kills=4), participant(1, kills=2)], teams)
    doc2 = document(2, [participant(5)], teams)
    overwrite_partitions(bronze_rows(spark, [doc1, doc1, "not json"], DAY1), bronze)
    overwrite_partitions(bronze_rows(spark, [doc2], DAY2), bronze)
    for day in (DAY1, DAY2):
        run_bronze_to_silver(spark, bronze, silver, day, quarantine)
        run_silver_to_gold(spark, silver, gold, day)
    perf = spark.read.parquet(gold["player_performance"])
    assert sorted((r.match_id, r.participant_id, r.total_kills, r.partition_date) for r in perf.collect()) == [
        (1, 1, 2, DAY1), (1, 2, 4, DAY1), (2, 1, 1, DAY2)]
    team = spark.read.parquet(gold["team_performance"]).where("match_id = 1").first()
    assert (team.total_baron_kills, team.total_dragon_kills, team.total_tower_kills) == (1, 2, 3)
    assert team.win_status == "true"
    assert spark.read.parquet(silver["teams_bans"]).count() == 2
    assert spark.read.parquet(gold["match_summary"]).count() == 2
    assert spark.read.parquet(quarantine).count() == 1


def test_match_relanded_on_a_later_date_is_not_counted_twice(spark):
    bronze = fresh_path(spark, "s-bronze")
    out = {k: fresh_path(spark, f"s-{k}") for k in ("games", "participants")}
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)])], DAY1), bronze)
    overwrite_partitions(bronze_rows(spark, [document(1, [participant(1)]),
                                             document(2, [participant(2)])], DAY2), bronze)
    for day in (DAY1, DAY2):
        run_bronze_to_silver(spark, bronze, out, day, skip_seen=True)
    games = sorted((r.match_id, r.partition_date) for r in spark.read.parquet(out["games"]).collect())
    assert games == [(1, DAY1), (2, DAY2)]
    assert spark.read.parquet(out["participants"]).count() == 2


def test_empty_null_arrays_odd_numbers_and_missing_flags(spark):
    docs = [
        {"info": {"gameId": 10, "participants": [], "teams": None}},
        {"info": {"gameId": 11, "participants": None,
                  "teams": [{"teamId": 100, "bans": []}, {"teamId": 200, "bans": None}]}},
        {"info": {"gameId": 12, "participants": [{"championId": 4.5, "kills": 2}, {"championId": 1}],
                  "teams": [{"teamId": 100, "bans": [{"pickTurn": 1, "championId": -1}]}]}},
    ]
    d = D.silver_input(bronze_rows(spark, docs))
    assert sorted(r.match_id for r in D.games(d).collect()) == [10, 11, 12]
    parts = {(r.match_id, r.champion_id, r.kills, r.win) for r in D.participants(d).collect()}
    assert parts == {(12, None, 2, None), (12, 1, None, None)}           # 4.5 is no int; win missing
    assert sorted((r.match_id, r.team_id) for r in D.team_stats(d).collect()) == \
        [(11, 100), (11, 200), (12, 100)]
    assert [(r.team_id, r.champion_id) for r in D.team_bans(d).collect()] == [(100, -1)]
    perf = R.team_performance(D.team_stats(d)).where("match_id = 11").collect()
    assert {r.win_status for r in perf} == {None}
