"""Randomised: duplicating and reordering landed documents never changes silver."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ingot.operators import documents as D
from test_semantics import bronze_rows, document, participant

TEAMS = [{"teamId": 100, "win": True, "objectives": {"baron": {"kills": 1}},
          "bans": [{"pickTurn": 1, "championId": 9}, {"pickTurn": 1, "championId": 9}]}]
DOCS = [document(g, [participant(c, team=100 + 100 * (c % 2), kills=c * g % 7)
                     for c in (3, 1, 3, 2)][: 1 + g % 4], TEAMS) for g in range(1, 6)]


def silver(spark, docs):
    d = D.silver_input(bronze_rows(spark, docs))
    return [sorted(tuple(r) for r in f(d).collect())
            for f in (D.games, D.participants, D.team_stats, D.team_bans)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(copies=st.lists(st.integers(min_value=1, max_value=3), min_size=len(DOCS), max_size=len(DOCS)),
       order=st.randoms(use_true_random=False))
def test_duplicates_and_order_do_not_change_silver(spark, copies, order):
    landed = [json.dumps(d) for d, n in zip(DOCS, copies) for _ in range(n)]
    order.shuffle(landed)
    assert silver(spark, landed) == silver(spark, [json.dumps(d) for d in DOCS])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(points=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 600),
                                 st.integers(0, 50)), min_size=1, max_size=60,
                       unique_by=lambda p: (p[0], p[1])))
def test_bucketed_windows_match_one_partition_per_series(spark, points):
    import datetime as dt

    from pyspark.sql import functions as F

    from ingot.operators import metrics as M
    rows = [("m", {"s": s}, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), float(v))
            for s, m, v in points]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, "
                                     "ts timestamp_ntz, value double").withColumn("s", F.col("labels")["s"])

    def key(frame, col):
        return sorted((r.s, r.ts, round(r[col], 9)) for r in frame.collect())
    # a bucket as long as the whole span is one partition per series
    assert key(M.rate(df, ["s"], 1800, bucket_s=1800), "rate") == \
        key(M.rate(df, ["s"], 1800, bucket_s=10 ** 6), "rate")
    assert key(M.delta(df, ["s"], 1800, bucket_s=1800), "delta") == \
        key(M.delta(df, ["s"], 1800, bucket_s=10 ** 6), "delta")
