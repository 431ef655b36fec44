"""k-anonymity by generalising (R4 + R6): every row stays, in a class of at least k rows.

Rows are first counted into cells of a grid over the quasi-identifiers (``bins`` quantile
bins each), in one aggregate.  All later work is on the cells: in each round every class
that can be cut is cut in two at the median of its widest column, found from histograms
of all classes at once.  Classes are ranges per column, so a row is published with its
class's ranges instead of its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path, remove_path


def _edges(df: DataFrame, quasi: list[str], bins: int) -> dict[str, list[float]]:
    """Upper edges of each column's quantile bins: at most ``bins`` numbers a column."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*(F.percentile_approx(F.col(c).cast("double"), shares, 100 * bins).alias(c)
                   for c in quasi)).first()
    return {c: sorted(set(row[c] or [])) for c in quasi}


def _bin(column: Column, edges: list[float]) -> Column:
    """A value's bin, by the number of edges below it; -1 for null."""
    if not edges:
        return F.when(column.isNull(), -1).otherwise(0)
    below = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0),
                        lambda n, e: n + (column.cast("double") > e).cast("int"))
    return F.when(column.isNull(), -1).otherwise(below)


def _widest_cut(cells: DataFrame, dims: list[str], k: int, spans: dict[str, int]) -> DataFrame:
    """``class, dim, cut`` for every class that can be cut: into bins up to ``cut`` and above.

    One histogram per class and column, of at most as many bins as the grid has; a cut leaves
    ``k`` rows on both sides and lies nearest the median.  Of a class's columns the widest
    one (in shares of the grid) that has such a cut is taken, the first of equals.
    """
    long = cells.select("class", "n", F.inline(F.array(*(
        F.struct(F.lit(i).alias("dim"), F.col(d).alias("bin")) for i, d in enumerate(dims)))))
    hist = long.groupBy("class", "dim", "bin").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("class", "dim")
    up = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = hist.select("class", "dim", "bin", F.sum("n").over(up).alias("below"), F.sum("n").over(own)
                      .alias("total"), (F.max("bin").over(own) - F.min("bin").over(own)).alias("wide"))
    share = F.element_at(F.create_map(*(F.lit(x) for i, d in enumerate(dims)
                                        for x in (i, 1.0 / max(1, spans[d])))), F.col("dim"))
    ok = run.where((F.col("below") >= k) & (F.col("total") - F.col("below") >= k))
    best = ok.groupBy("class", "dim").agg(
        F.min(F.struct(F.abs(2 * F.col("below") - F.col("total")), "bin")).alias("near"),
        F.max(F.col("wide") * share).alias("wide"))
    return best.groupBy("class").agg(F.max(F.struct("wide", (-F.col("dim")).alias("order"),
                                                    F.col("near.bin").alias("cut"))).alias("top")).select(
        "class", (-F.col("top.order")).alias("dim"), F.col("top.cut").alias("cut"))


def generalize_to_classes(df: DataFrame, quasi: list[str], k: int, bins: int = 256,
                          max_rounds: int = 64) -> DataFrame:
    """``df`` with each numeric or date-like column of ``quasi`` replaced by ``<name>_low`` and
    ``<name>_high``, the range of its class, and ``class_size``.

    Every row stays and every class has at least ``k`` rows, but for a table of fewer than
    ``k``, which is one class.  Nulls are a bin below all values; a class that holds only
    nulls in a column has no range there.  Values of one bin are never told apart.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = df.sparkSession
    edges = _edges(df, quasi, bins)
    dims = [f"_bin_{c}" for c in quasi]
    spans = {d: len(edges[c]) + 1 for c, d in zip(quasi, dims, strict=True)}
    binned = df.withColumns({d: _bin(F.col(c), edges[c]) for c, d in zip(quasi, dims, strict=True)})
    cells = binned.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("n"),
        *(f(F.col(c)).alias(f"{c}_{name}") for c in quasi for name, f in (("low", F.min), ("high", F.max))))
    root, written = fresh_path(spark, "classes"), 0

    def keep(rows: DataFrame) -> DataFrame:
        nonlocal written
        written += 1
        path = f"{root}/{written}"
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    cells = keep(cells.withColumn("class", F.lit("")))
    for _ in range(max_rounds):
        cuts = keep(_widest_cut(cells, dims, k, spans))
        if cuts.isEmpty():
            break
        at = F.element_at(F.array(*dims), F.col("dim") + 1)
        side = F.when(F.col("cut").isNull(), "").when(at <= F.col("cut"), "0").otherwise("1")
        cells = keep(cells.join(cuts, "class", "left").withColumn(
            "class", F.concat("class", side)).drop("dim", "cut"))
    ranges = cells.groupBy("class").agg(F.sum("n").alias("class_size"), *(
        f(f"{c}_{name}").alias(f"{c}_{name}") for c in quasi
        for name, f in (("low", F.min), ("high", F.max))))
    lookup = keep(cells.select("class", *dims).join(ranges, "class"))
    out = binned.join(lookup, dims).drop(*dims, *quasi, "class")
    result = keep(out)
    for i in range(1, written):
        remove_path(spark, f"{root}/{i}")
    return result
