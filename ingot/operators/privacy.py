"""Data-protection transforms named in the reference's README.

All are column expressions or one decomposable aggregate plus a semi-join, so
they run at scan speed and never gather a group in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def generalize(df: DataFrame, widths: dict[str, float] | None = None,
               truncate: dict[str, str] | None = None, suffix: str = "_band") -> DataFrame:
    """Numbers to the lower edge of a band (``floor(x / w) * w``); times to a
    coarser unit (``date_trunc``).  New columns are ``<name><suffix>``; the
    originals are dropped (R4)."""
    out = df
    for c, w in (widths or {}).items():
        out = out.withColumn(c + suffix, F.floor(F.col(c) / w) * w).drop(c)
    for c, unit in (truncate or {}).items():
        out = out.withColumn(c + suffix, F.date_trunc(unit, F.col(c))).drop(c)
    return out


def suppress(df: DataFrame, columns: list[str], when: Column | None = None) -> DataFrame:
    """Null out ``columns`` (on every row, or only where ``when`` holds), keeping
    their types (R5)."""
    def blank(c: str) -> Column:
        null = F.lit(None).cast(df.schema[c].dataType)
        return null if when is None else F.when(when, null).otherwise(F.col(c))
    return df.withColumns({c: blank(c) for c in columns})


def k_anonymous(df: DataFrame, quasi: list[str], k: int) -> DataFrame:
    """Rows whose quasi-identifier combination occurs at least ``k`` times.

    Group sizes come from one aggregate (combined map-side); a semi-join keeps
    the rows of large-enough groups.  Null-safe equality lets a null quasi
    value form a group like any other.  A hot group is just a skewed join key,
    which AQE splits.
    """
    sizes = (df.groupBy(*quasi).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") >= k).drop("_n"))
    left, right = df.alias("_l"), sizes.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in quasi])
    return left.join(right, cond, "left_semi")


def tokenize(df: DataFrame, columns: list[str], salt: str, suffix: str = "_token") -> DataFrame:
    """Replace identifiers by salted SHA-256 tokens (hex), stable across runs so
    tokenised tables still join on them (R7)."""
    out = df
    for c in columns:
        out = out.withColumn(c + suffix, F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")),
                                                256)).drop(c)
    return out
