"""Enrichment: the seed -> history -> document chain as joins.

The reference walks each message through remote lookups one at a time; here
each lookup is a table and each hop one join, so a batch (or micro-batch) of
seeds is enriched in a few distributed operators:

    snapshot --explode--> seeds --join identity--> seeds + puuid
      --join history lists (latest n per player)--> --explode--> detail messages
      --join documents--> match messages

Inner joins drop a seed whose lookup fails (quirk Q15) and a player with no
matches (P10).  Every function is ``DataFrame -> DataFrame`` and works on
batch and streaming seeds alike (stream-static joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup_join

DEFAULT_N = 5   # matches per player (the reference's default count)


def seed_entries(snapshots: DataFrame, taken_at, keep=()) -> DataFrame:
    """Leaderboard snapshots -> one seed message per entry.

    ``taken_at`` is the snapshot's stage time (ISO text or a column).
    """
    ts = taken_at if isinstance(taken_at, F.Column) else F.lit(taken_at)
    return snapshots.select(*keep, F.explode("entries").alias("entry")).select(
        *keep, ts.alias("timestamp_summoner"), F.col("entry.summonerId").alias("summonerId"))


def resolve_identity(seeds: DataFrame, identity: DataFrame) -> DataFrame:
    """Player id -> player key; unknown players are dropped."""
    return lookup_join(seeds, identity.select("summonerId", "puuid"), "summonerId", "inner")


def recent_n(history: DataFrame, n: int = DEFAULT_N, key: str = "puuid",
             time_col: str = "played_at", id_col: str = "match_id") -> DataFrame:
    """The latest ``n`` rows per key, newest first, with their rank (O2).

    ``row_number() <= n`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so even a key holding a third of all rows sends at
    most ``n`` rows per map task to the exchange.  Ties on time fall to the id.
    """
    w = Window.partitionBy(key).orderBy(F.col(time_col).desc(), F.col(id_col).desc())
    return (history.withColumn("recency", F.row_number().over(w))
            .where(F.col("recency") <= n))


def history_lists(history: DataFrame, n: int = DEFAULT_N, key: str = "puuid") -> DataFrame:
    """One row per player: the ids of their latest ``n`` matches, newest first.

    The list is bounded by ``n``, so the grouped ``collect_list`` never holds
    more than ``n`` entries whatever the player's history size.
    """
    top = recent_n(history, n, key)
    return (top.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct("recency", "match_id"))).alias("_h"))
            .select(key, F.transform("_h", lambda h: h["match_id"]).alias("match_ids")))


def expand_history(resolved: DataFrame, lists: DataFrame, processed_at) -> DataFrame:
    """Seeds with a player key -> one detail message per recent match.

    The lookup returns one list per player, so the join is 1:1 per seed; the
    fan-out to ``n`` rows happens after it, in ``explode``.
    """
    ts = processed_at if isinstance(processed_at, F.Column) else F.lit(processed_at)
    j = lookup_join(resolved, lists, "puuid", "inner").where(F.size("match_ids") > 0)
    return j.select("timestamp_summoner", "summonerId",
                    ts.alias("timestamp_summoner_details"),
                    F.explode("match_ids").alias("match_id"))


def attach_documents(details: DataFrame, documents: DataFrame, fetched_at) -> DataFrame:
    """Detail messages -> match messages carrying the document.

    The document table is large, so this normally stays a shuffle join on ``match_id``.
    """
    ts = fetched_at if isinstance(fetched_at, F.Column) else F.lit(fetched_at)
    j = lookup_join(details, documents.select("match_id", "match_details"), "match_id", "inner")
    return j.select("timestamp_summoner", "summonerId", "timestamp_summoner_details",
                    "match_id", ts.alias("timestamp_match"), "match_details")


def enrich(seeds: DataFrame, identity: DataFrame, history: DataFrame, documents: DataFrame,
           processed_at, fetched_at, n: int = DEFAULT_N) -> DataFrame:
    """The whole chain from seeds to match messages."""
    resolved = resolve_identity(seeds, identity)
    details = expand_history(resolved, history_lists(history, n), processed_at)
    return attach_documents(details, documents, fetched_at)


RETRY_COLUMNS = ["timestamp_summoner", "summonerId", "match_id", "reason"]


def enrich_with_retries(seeds: DataFrame, identity: DataFrame, history: DataFrame,
                        documents: DataFrame, processed_at, fetched_at,
                        n: int = DEFAULT_N) -> tuple[DataFrame, DataFrame]:
    """The chain, keeping what it cannot enrich (Q14, Q15): ``(match
    messages, retries)``.

    One chain of left joins (each lookup joined once) with ``explode_outer``
    marks every row with the first lookup that missed: ``unknown_player`` (no
    player key), ``no_history`` (no matches) or ``no_document``.  Messages and
    retries are two filters of the same rows; a job writing both should
    checkpoint the marked rows first.  A later run over the retry table can
    enrich them once the reference data has caught up.
    """
    marked = mark_documents(mark_history(seeds, identity, history_lists(history, n),
                                         processed_at), documents, fetched_at)
    return enriched(marked), retries(marked)


def _column(value):
    return value if isinstance(value, F.Column) else F.lit(value)


def mark_history(seeds: DataFrame, identity: DataFrame, lists: DataFrame,
                 processed_at, keep=()) -> DataFrame:
    """Hop 1: seeds -> one row per recent match, ``reason`` set where a lookup missed."""
    found = lookup_join(lookup_join(seeds, identity.select("summonerId", "puuid"), "summonerId",
                                    "left"), lists, "puuid", "left")
    rows = found.select(*keep, "timestamp_summoner", "summonerId", "puuid",
                        _column(processed_at).alias("timestamp_summoner_details"),
                        F.explode_outer("match_ids").alias("match_id"))
    return rows.withColumn("reason", F.when(F.col("puuid").isNull(), "unknown_player")
                           .when(F.col("match_id").isNull(), "no_history")).drop("puuid")


def mark_documents(details: DataFrame, documents: DataFrame, fetched_at) -> DataFrame:
    """Hop 2: details -> the same rows with their document; ``reason`` set where it is missing.

    A reason that ``details`` already carries stays."""
    if "reason" not in details.columns:
        details = details.withColumn("reason", F.lit(None).cast("string"))
    docs = documents.select("match_id", "match_details").withColumn("_doc", F.lit(True))
    rows = lookup_join(details, docs, "match_id", "left")
    return rows.withColumn("timestamp_match", _column(fetched_at)).withColumn(
        "reason", F.coalesce("reason", F.when(F.col("_doc").isNull(), "no_document"))).drop("_doc")


def enriched(marked: DataFrame) -> DataFrame:
    """The rows every lookup knew."""
    return marked.where(F.col("reason").isNull()).drop("reason").select(
        *[c for c in ("timestamp_summoner", "summonerId", "timestamp_summoner_details", "match_id",
                      "timestamp_match", "match_details") if c in marked.columns])


def retries(marked: DataFrame) -> DataFrame:
    """The rows some lookup missed, with the reason."""
    return marked.where(F.col("reason").isNotNull()).select(*RETRY_COLUMNS)
