"""Metric samples: label selection, unit scaling, legends, and trailing-range
delta / rate / sums over series (L11, P11, P15-P17, W2, W3, A6).

A sample is ``(metric, labels map<string,string>, ts, value)``; a series is a
metric plus a fixed set of label values.

Trailing-range windows are computed per (series, time bucket), not per series:
a series can hold a third of all samples, and a window partitioned by series
alone would sort all of it in one task.  Each sample is also copied into the
next bucket when it lies within ``range`` of that bucket's start (a *halo*), so
every frame ``[ts - range, ts]`` is complete inside its own bucket.  Buckets
default to ``BUCKET_RANGES`` times the range (a day for a one-hour range, two
hours for a five-minute one), so the halo adds about 4% of the rows whatever
the range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
BUCKET_RANGES = 24      # default bucket length, in ranges


def label(name: str) -> Column:
    return F.col("labels")[name]


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """``metric{k="v", ...}``: equality on the metric name and labels."""
    cond = F.col("metric") == metric
    for k, v in labels.items():
        cond = cond & (label(k) == v)
    return samples.where(cond)


def newest(samples: DataFrame):
    """The newest sample time (None without samples), as the driver's "now"."""
    return samples.agg(F.max("ts")).first()[0]


def last_hours(samples: DataFrame, hours: int, now) -> DataFrame:
    """Samples in the trailing ``hours`` before ``now``.

    ``now`` is a value, so the bound is known when the scan is planned: it is
    pushed to the files, and a table partitioned by day skips whole days.
    """
    if now is None:
        return samples.limit(0)
    return samples.where(F.col("ts") > F.lit(now - dt.timedelta(hours=hours)))


def to_mebibytes(df: DataFrame, col: str = "value", out: str = "value_mb") -> DataFrame:
    """``/1024/1024`` (heap panels)."""
    return df.withColumn(out, F.col(col) / 1024 / 1024)


def legend(template: str, labels: list[str], pattern: str | None = None,
           replacement: str | None = None) -> Column:
    """A series name from a ``printf`` template over label values (P16), then an
    optional regex rename (P15, Java regex with ``$n`` groups)."""
    text = F.format_string(template, *[label(k) for k in labels])
    if pattern is not None:
        text = F.regexp_replace(text, pattern, replacement or "$0")
    return text


def _micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def with_halo(samples: DataFrame, range_s: int, bucket_s: int | None = None) -> DataFrame:
    """Add ``_t`` (epoch micros), ``_bucket`` and ``_own`` (False on halo copies)."""
    bucket_s = bucket_s or BUCKET_RANGES * range_s
    if range_s > bucket_s:
        raise ValueError("the range must not exceed the bucket")
    t = _micros()
    b = F.floor(t / (bucket_s * MICROS))
    near_next = t >= (b + 1) * (bucket_s * MICROS) - range_s * MICROS
    shifts = F.when(near_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (samples.withColumn("_t", t).withColumn("_b0", b)
            .withColumn("_shift", F.explode(shifts))
            .withColumn("_bucket", F.col("_b0") + F.col("_shift"))
            .withColumn("_own", F.col("_shift") == 0)
            .drop("_b0", "_shift"))


def delta(samples: DataFrame, series: list[str], range_s: int,
          bucket_s: int | None = None, per_s: int | None = None) -> DataFrame:
    """``delta(series[range])``: last minus first value in the trailing range,
    at every sample; divided by ``per_s`` seconds' worth of range units when
    given (``/5`` on a 5-minute range is ``per_s=60``).  No extrapolation."""
    h = with_halo(samples, range_s, bucket_s)
    first = _at_range_start(h.repartition(*series, "_bucket"), series, range_s, F.struct("value"))
    d = F.col("value") - F.col("_first")["value"]
    if per_s:
        d = d / (range_s / per_s)
    return first.withColumn("delta", d).drop("_t", "_bucket", "_own", "_first")


def _at_range_start(h: DataFrame, series: list[str], range_s: int, what: Column,
                    tiebreak: str = "value") -> DataFrame:
    """The own samples of ``with_halo`` with ``_first``, the struct ``what`` of the first sample
    in ``[_t - range, _t]`` (of several at one time, the smallest ``tiebreak``).  ``h`` lies
    by series and bucket.

    Each sample also asks, as a row of its own at ``_t - range``, for the sample that follows.
    Backwards in time that is the last one seen, a growing frame: one pass over the
    bucket, where a sliding frame is gone through anew for every sample.
    """
    rows = h.withColumn("_asks", F.explode(
        F.when(F.col("_own"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    at = F.when(F.col("_asks"), F.col("_t") - range_s * MICROS).otherwise(F.col("_t"))
    back = (Window.partitionBy(*series, "_bucket")
            .orderBy(F.col("_at").desc(), F.col("_asks"), F.col(tiebreak).desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = F.last(F.when(~F.col("_asks"), what), ignorenulls=True).over(back)
    return (rows.withColumn("_at", at).withColumn("_first", seen)
            .where("_asks").drop("_asks", "_at"))


def rate(samples: DataFrame, series: list[str], range_s: int, tiebreak: str = "value",
         bucket_s: int | None = None) -> DataFrame:
    """``rate(counter[range])``: per-second increase over the trailing range.

    Increments come from the previous sample of the series; a drop means the
    counter reset and the new value is the increment.  The first sample in a
    frame contributes no increment (its predecessor lies before the frame).
    Every predecessor that matters lies in the frame, hence in the bucket.  Samples
    at one time follow each other by ``tiebreak``.
    """
    h = with_halo(samples, range_s, bucket_s).repartition(*series, "_bucket")
    order = Window.partitionBy(*series, "_bucket").orderBy("_t", tiebreak)
    prev = F.lag("value").over(order)
    inc = (F.when(prev.isNull(), F.lit(0.0))
           .when(F.col("value") < prev, F.col("value"))
           .otherwise(F.col("value") - prev).cast("double"))
    # What a frame's sum is, is the difference of two running sums: one pass over the bucket,
    # where a sliding frame is gone through anew for every sample.  Infinite and undefined
    # increments are counted beside the sums, which they would spoil from there on.
    odd = F.isnan("_inc") | (F.abs("_inc") == float("inf"))
    parts = {"_sum": F.when(odd, 0.0).otherwise(F.col("_inc")),
             **{f"_{name}": F.when(F.col("_inc") == F.lit(float(name)), 1).otherwise(0)
                for name in ("nan", "inf", "-inf")}}
    every = Window.partitionBy(*series, "_bucket").orderBy("_t")
    through = every.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = every.rangeBetween(Window.unboundedPreceding, -1)
    equal = order.rangeBetween(Window.currentRow, Window.currentRow)

    def sums(w) -> Column:
        return F.struct(*[F.coalesce(F.sum(p).over(w), F.lit(0)).alias(k) for k, p in parts.items()])
    h = h.withColumn("_inc", inc).withColumns({
        "_through": sums(through), "_before": sums(before),
        "_least": F.min(F.struct("_inc")).over(equal)["_inc"]})     # of samples alike in time and tiebreak
    r = _at_range_start(h, series, range_s, F.struct("_least", "_before"), tiebreak)
    first = F.col("_first")["_least"]
    # Samples without a time are a bucket of their own, with nothing before them.
    grown = {k: F.col("_through")[k] - F.when(F.col("_t").isNull(), 0).otherwise(
        F.col("_first")["_before"][k]) for k in parts}
    total = (F.when(first.isNull(), F.lit(None).cast("double"))
             .when(F.isnan(first) | (F.abs(first) == float("inf")) | (grown["_nan"] > 0)
                   | ((grown["_inf"] > 0) & (grown["_-inf"] > 0)), float("nan"))
             .when(grown["_inf"] > 0, float("inf")).when(grown["_-inf"] > 0, float("-inf"))
             .otherwise(grown["_sum"] - first))
    return r.withColumn("rate", total / range_s).drop(
        "_t", "_bucket", "_own", "_inc", "_through", "_before", "_least", "_first")


def sum_by(df: DataFrame, value: str, by: list, out: str) -> DataFrame:
    """``sum(expr) by (labels)`` at each evaluation time."""
    return df.groupBy(*by).agg(F.sum(value).alias(out))


def _micros_of_cell(step: int) -> Column:
    """The grid time at which a sample is first in a window: its time, rounded up to a step."""
    return F.ceil(_micros() / step) * step


def _points(cells: DataFrame, series: list[str], range_s: int, step_s: int,
            beside: dict[str, Column] | None = None) -> DataFrame:
    """One row per cell and grid time ``_t`` whose window ``(t - range, t]`` holds the cell.

    A cell is what a series' samples of one step are reduced to (``_cell``, its end).
    Cells are dealt out by (series, bucket of ``BUCKET_RANGES`` ranges), with a copy into the
    next bucket where their windows reach it (about 4 %), and only there, after the
    exchange, fan out to the ``range / step`` grid times.  ``beside`` adds columns over
    ``cell_order`` between the two, from the cells around: all cells of a window that
    ends in a bucket lie in it.
    """
    if range_s % step_s:
        raise ValueError("the range must be a whole number of steps")
    step, reach, bucket = step_s * MICROS, range_s * MICROS, BUCKET_RANGES * range_s * MICROS
    own = F.floor(F.col("_cell") / bucket)
    spill = F.col("_cell") + (reach - step) >= (own + 1) * bucket
    cells = cells.withColumn("_bucket", F.explode(
        F.when(spill, F.array(own, own + 1)).otherwise(F.array(own))))
    return (cells.repartition(*series, "_bucket").withColumns(beside or {})
            .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(range_s // step_s - 1))))
            .withColumn("_t", F.col("_cell") + F.col("_k").cast("long") * step)
            .where(F.floor(F.col("_t") / bucket) == F.col("_bucket")))


def cell_order(series: list[str]):
    return Window.partitionBy(*series, "_bucket").orderBy("_cell")


def _grid_time() -> Column:
    return F.timestamp_micros("_t").cast("timestamp_ntz").alias("t")


def _sample() -> Column:
    return F.struct(_micros().alias("at"), F.col("value").alias("value"))


def delta_on_grid(samples: DataFrame, series: list[str], range_s: int, step_s: int = 60,
                  per_s: int | None = None) -> DataFrame:
    """``delta(series[range])`` evaluated on a ``step`` grid, as a dashboard
    evaluates it: at each grid time ``t``, last minus first sample value in
    ``(t - range, t]``, where at least two samples fall in that window.

    Samples between two grid times lie in the same windows, so each (series,
    step) is first reduced, map-side, to one cell: its first and last sample and
    their number (then see ``_points``).  Samples at one time are ordered by value.
    Output: ``series..., t, delta``.
    """
    cells = (samples.select(*series, _micros_of_cell(step_s * MICROS).alias("_cell"),
                            _sample().alias("_s"))
             .groupBy(*series, "_cell")
             .agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"),
                  F.count(F.lit(1)).alias("_n")))
    d = (_points(cells, series, range_s, step_s).groupBy(*series, "_bucket", "_t")
         .agg(F.sum("_n").alias("_n"),
              (F.max("_last")["value"] - F.min("_first")["value"]).alias("delta"))
         .where(F.col("_n") >= 2).select(*series, _grid_time(), "delta"))
    if per_s:
        d = d.withColumn("delta", F.col("delta") / (range_s / per_s))
    return d


def counter_cells(samples: DataFrame, series: list[str], step_s: int = 60) -> DataFrame:
    """A counter's samples reduced to one mergeable cell per series and step: ``_first`` and
    ``_last`` sample, ``_inc`` (the increases between its samples, a fall being a restart
    from 0) and their number ``_n``.

    Cells that follow each other merge: first of one, last of the other, both increases
    and the seam's (``seam``).  A cell gathers one step of one series, a handful of
    samples; those of a map task are put together before the shuffle.
    """
    gathered = samples.select(*series, _micros_of_cell(step_s * MICROS).alias("_cell"),
                              _sample().alias("_s")).groupBy(*series, "_cell").agg(
        F.sort_array(F.collect_list("_s")).alias("_all"))
    steps = F.transform(F.slice("_all", 2, F.size("_all")), lambda s, i: increase(
        F.get("_all", i)["value"], s["value"]))
    return gathered.select(*series, "_cell", F.get("_all", F.lit(0)).alias("_first"),
                           F.element_at("_all", -1).alias("_last"),
                           F.aggregate(steps, F.lit(0.0), lambda a, x: a + x).alias("_inc"),
                           F.size("_all").cast("long").alias("_n"))


def increase(before: Column, after: Column) -> Column:
    """What a counter grew by from one sample to the next; after a restart, its new value."""
    return F.when(after < before, after).otherwise(after - before)


def rate_on_grid(samples: DataFrame, series: list[str], range_s: int, step_s: int = 60,
                 per_s: int = 1) -> DataFrame:
    """``rate(series[range])`` on a ``step`` grid, per ``per_s`` seconds: the increases between
    the samples in ``(t - range, t]`` over the range, where at least two fall in it.

    A fall is a restart and counts its new value, so a rate is never negative.  The increase
    up to a window's first sample belongs to the window before.  No extrapolation.
    Samples at one time follow each other by value.  Output: ``series..., t, rate``.
    """
    cells = counter_cells(samples, series, step_s)
    before = F.lag("_last").over(cell_order(series))
    seam = F.coalesce(increase(before["value"], F.col("_first")["value"]), F.lit(0.0))
    points = _points(cells, series, range_s, step_s, {"_seam": seam})
    first = F.min(F.struct("_cell", "_seam"))["_seam"]
    r = points.groupBy(*series, "_bucket", "_t").agg(
        F.sum("_n").alias("_n"), (F.sum(F.col("_inc") + F.col("_seam")) - first).alias("_grown"))
    return r.where(F.col("_n") >= 2).select(*series, _grid_time(), (
        F.greatest(F.col("_grown"), F.lit(0.0)) * per_s / range_s).alias("rate"))


def instant_on_grid(samples: DataFrame, series: list[str], staleness_s: int = 300,
                    step_s: int = 60) -> DataFrame:
    """An instant vector on a ``step`` grid: at each grid time the value of the series' last
    sample no older than ``staleness_s``; no row where there is none.

    Each (series, step) is reduced, map-side, to its last sample, which is carried to the
    grid times within its staleness, over bucket ends too.  Of samples at one time the
    largest value counts.  Output: ``series..., t, value``.
    """
    cells = samples.select(*series, _micros_of_cell(step_s * MICROS).alias("_cell"),
                           _sample().alias("_s")).groupBy(*series, "_cell").agg(
        F.max("_s").alias("_last"))
    return _points(cells, series, staleness_s, step_s).groupBy(*series, "_bucket", "_t").agg(
        F.max("_last")["value"].alias("value")).select(*series, _grid_time(), "value")


def side_by_side(df: DataFrame, metric: str, value: str, by: list[str],
                 names: dict[str, str]) -> DataFrame:
    """One row per ``by`` with a column per metric (panels that draw two metrics): the
    metric's summed ``value``, null where it has none.  One aggregate, no join."""
    return df.groupBy(*by).agg(*[F.sum(F.when(F.col(metric) == m, F.col(value))).alias(out)
                                 for m, out in names.items()])
