"""Lookup joins.

The reference's remote lookups (player id -> key, key -> matches, match id ->
document) become joins against reference tables.  No hint is given: the planner
broadcasts a lookup side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold``, AQE may still do so from the measured
shuffle size, and it splits skewed partitions of the large side.  Micro-batches
of stateless streams are re-planned too
(``spark.sql.adaptive.streaming.stateless.enabled``, on by default).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(stream: DataFrame, lookup: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a large (possibly streaming) side with a lookup table."""
    return stream.join(lookup, on, how)
