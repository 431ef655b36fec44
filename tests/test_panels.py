"""Panels on the evaluation grid against hand evaluation: restarts, gaps, ties, bucket ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ingot.operators import metrics as M

START = dt.datetime(2024, 1, 1)


def frame(spark, points):
    rows = [(s, START + dt.timedelta(seconds=at), float(v)) for s, at, v in points]
    return spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")


def windows(points, range_s, step_s):
    """(series, grid time) -> the samples in (t - range, t], by time and value."""
    out = {}
    for s, at, v in points:
        first = -(-at // step_s) * step_s
        for t in range(int(first), int(first) + range_s, step_s):
            if t - range_s < at <= t:
                out.setdefault((s, t), []).append((at, v))
    return {k: sorted(v) for k, v in out.items()}


def seconds(t):
    return int((t - START).total_seconds())


def random_points(seed, span):
    rng = random.Random(seed)
    points, value = [], {"a": 0, "b": 0}
    for at in sorted(rng.sample(range(span), 120)):
        s = rng.choice("ab")
        value[s] = rng.randint(0, 9) if rng.random() < 0.2 else value[s] + rng.randint(0, 50)
        points.append((s, at, value[s]))
        if rng.random() < 0.2:                                       # a tie in time
            points.append((s, at, value[s] + 5))
    return points


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rate_survives_restarts_gaps_and_bucket_ends(spark, seed):
    points = random_points(seed, 30_000)                             # four buckets of 24 x 300 s
    want = {}
    for key, own in windows(points, 300, 60).items():
        if len(own) > 1:
            grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(own, own[1:]))
            want[key] = round(grown / 300, 9)
    got = M.rate_on_grid(frame(spark, points), ["s"], 300, 60).collect()
    assert {(r.s, seconds(r.t)): round(r.rate, 9) for r in got} == want
    assert len(got) == len(want) and all(r.rate >= 0 for r in got)


@pytest.mark.parametrize("seed", [4, 5])
def test_instant_values_end_with_their_staleness(spark, seed):
    points = random_points(seed, 60_000)                             # gaps longer than 300 s
    want = {key: max(own, key=lambda x: x)[1] for key, own in windows(points, 300, 60).items()}
    got = M.instant_on_grid(frame(spark, points), ["s"], 300, 60).collect()
    assert {(r.s, seconds(r.t)): r.value for r in got} == want and len(got) == len(want)
    covered = {t for s, t in want if s == "a"}
    assert len(covered) < (max(covered) - min(covered)) // 60         # some minutes hold nothing


def test_a_counter_that_restarts_is_no_negative_rate(spark):
    points = [("a", at, v) for at, v in ((10, 1000), (70, 2000), (130, 10), (190, 20))]
    got = {seconds(r.t): r.rate for r in M.rate_on_grid(frame(spark, points), ["s"], 300, 60,
                                                        per_s=60).collect()}
    assert got[240] == (1000 + 10 + 10) * 60 / 300
    delta = {seconds(r.t): r.delta for r in M.delta_on_grid(frame(spark, points), ["s"], 300, 60).collect()}
    assert delta[240] == -980                                        # what a delta makes of it


def test_cells_merge_to_the_whole(spark):
    """Increases of the cells and of the seams between them are the counter's increases."""
    points = random_points(9, 3_000)
    cells = M.counter_cells(frame(spark, points), ["s"], 60).where("s = 'a'").orderBy("_cell").collect()
    total = sum(c._inc for c in cells)
    for a, b in zip(cells, cells[1:]):
        last, first = a._last["value"], b._first["value"]
        total += first if first < last else first - last
    own = sorted((at, v) for s, at, v in points if s == "a")
    assert total == sum(b if b < a else b - a for (_, a), (_, b) in zip(own, own[1:]))
    assert sum(c._n for c in cells) == len(own)


def test_empty_tables_give_empty_panels(spark):
    none = frame(spark, [("a", 1, 1)]).limit(0)
    assert M.rate_on_grid(none, ["s"], 300).count() == 0
    assert M.instant_on_grid(none, ["s"]).count() == 0


def test_panels_fan_out_behind_the_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = frame(spark, [("a", 1, 1)]).withColumn("value", F.col("value") + 1)
        for panel in (M.rate_on_grid(df, ["s"], 300), M.instant_on_grid(df, ["s"])):
            plan = panel._jdf.queryExecution().executedPlan().toString()
            dealt = plan.index("REPARTITION_BY_COL")
            fan = "Generate explode(org.apache"
            assert fan in plan[:dealt] and fan not in plan[dealt:]
            # Everything behind the deal stays in its tasks.
            assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
