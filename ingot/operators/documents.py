"""Silver operators: key, deduplicate, parse and flatten match documents.

Plan shape (one parse and one shuffle for the whole silver layer)::

    bronze scan (ReadSchema: the text and stage times only)
      -> one from_json per document, schema pruned to what is read + gameId
         (behind a one-element inline, so that no filter repeats the parse)
      -> partial SortAggregate  (map-side: a hot match collapses per task)
      -> Exchange hashpartitioning(partition_date, match_id)
      -> final aggregate (one survivor per match)
      -> posexplode / explode   (rows are distinct inside their document)

Numbering participants sorts the (bounded) participants array inside its own
row and numbers it with ``posexplode``: the same ids a ``row_number`` window
over ``match_id`` gives, without a sort of the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parse_once
from ..functions.schemas import document_schema

MATCH_KEY = "match_id"

# The fields of the consumed documents and their names in silver.
GAME_FIELDS = [
    ("gameId", "match_id"), ("gameCreation", "game_creation"),
    ("gameDuration", "game_duration"), ("gameMode", "game_mode"),
    ("gameVersion", "game_version"), ("mapId", "map_id"), ("queueId", "queue_id"),
    ("platformId", "platform_id"), ("gameStartTimestamp", "game_start_timestamp"),
    ("gameEndTimestamp", "game_end_timestamp"),
]
GAME_COLUMNS = [out for _, out in GAME_FIELDS] + ["partition_date"]

# Participant fields in silver, with their output names (document order kept
# where the source keeps it).
PARTICIPANT_OUTPUT = [
    ("championId", "champion_id"), ("championName", "champion_name"),
    ("teamId", "team_id"), ("individualPosition", "individual_position"),
    ("lane", "lane"), ("kills", "kills"), ("deaths", "deaths"), ("assists", "assists"),
    *[(f"item{k}", f"item{k}") for k in range(7)],
    ("allInPings", "allInPings"), ("itemsPurchased", "itemsPurchased"),
    ("wardsKilled", "wardsKilled"), ("wardsPlaced", "wardsPlaced"),
    ("totalDamageDealt", "total_damage_dealt"), ("totalDamageTaken", "total_damage_taken"),
    ("goldEarned", "gold_earned"), ("win", "win"),
]
PARTICIPANT_COLUMNS = (["match_id", "participant_id"]
                       + [out for _, out in PARTICIPANT_OUTPUT] + ["partition_date"])
TEAM_STAT_COLUMNS = ["match_id", "team_id", "win", "baron_kills", "dragon_kills",
                     "tower_kills", "partition_date"]
TEAM_BAN_COLUMNS = ["match_id", "team_id", "ban_turn", "champion_id", "partition_date"]



def with_match_key(bronze: DataFrame, info_fields=None, with_metadata: bool = False,
                   text: str = "match_details") -> DataFrame:
    """Parse each document once into ``doc`` and key it by ``match_id``.

    The schema is pruned to the ``info`` fields the consumer needs plus
    ``gameId`` (Spark prunes unused top-level fields of ``from_json`` by itself
    but not fields below a nested struct), so one parse serves both the key
    and the branch.  ``info_fields=None`` parses the whole document.  A row whose
    document is null, empty, garbage or without a game id has a null key.
    """
    if info_fields is not None and "gameId" not in info_fields:
        info_fields = ["gameId", *info_fields]
    parsed = parse_once(bronze, text, document_schema(info_fields, with_metadata), "doc")
    return parsed.withColumn(MATCH_KEY, F.col("doc.info.gameId"))


def dedupe_by_key(keyed: DataFrame, payload: str = "doc",
                  order_by: tuple = ("timestamp_match", "timestamp_summoner_details",
                                     "timestamp_summoner"),
                  by: tuple = ("partition_date",)) -> DataFrame:
    """One row per (partition_date, match_id): the latest landing survives.

    ``max(struct(...))`` is an ordinary aggregate, so Spark runs it partially
    before the shuffle: a match landed a million times costs one row per map
    task in the exchange, never a million rows in one reducer.  Ties on the
    stage times fall to the parsed document, so the survivor is deterministic.
    ``by=()`` groups on the match key alone (input of a single date), leaving
    the result hash-partitioned on ``match_id`` only.
    """
    present = [c for c in order_by if c in keyed.columns]
    best = F.max(F.struct(*[F.col(c) for c in present + [payload]])).alias("_best")
    return (keyed.groupBy(*by, MATCH_KEY).agg(best)
            .select(MATCH_KEY, *[F.col("_best")[c].alias(c) for c in present + [payload]],
                    *by))


def split_by_key(keyed: DataFrame, text: str = "match_details") -> tuple[DataFrame, DataFrame]:
    """(parsed documents with a match key, quarantined rows whose document did
    not parse).  Good rows drop the raw text; quarantined rows keep only it."""
    ok = keyed.where(F.col(MATCH_KEY).isNotNull()).drop(text)
    bad = keyed.where(F.col(MATCH_KEY).isNull()).drop("doc", MATCH_KEY)
    return ok, bad


def key_unparsed(keyed: DataFrame, text: str = "match_details") -> DataFrame:
    """Mark rows whose document did not parse (``_bad``) and keep their text in ``_raw``.

    Each bad row gets a number of its own in ``_bad_id`` (null for good rows), so
    that deduplication by ``(match_id, _bad_id)`` keeps every one of them with
    its stage times, repeated garbage included, while good documents still
    collapse by their match.  Bad rows spread over all partitions.
    """
    bad = F.col(MATCH_KEY).isNull()
    return (keyed.withColumn("_bad", bad).withColumn("_raw", F.when(bad, F.col(text)))
            .withColumn("_bad_id", F.when(bad, F.monotonically_increasing_id()))
            .drop(text))


def silver_input(bronze: DataFrame, info_fields=None, with_metadata: bool = False) -> DataFrame:
    """Bronze -> one parsed document per match and date (quarantine removed)."""
    ok, _ = split_by_key(with_match_key(bronze, info_fields, with_metadata))
    return dedupe_by_key(ok)


def drop_seen(docs: DataFrame, seen_keys: DataFrame) -> DataFrame:
    """Documents whose match is not among ``seen_keys`` (matches already in
    silver under an earlier date): a left-anti join on ``match_id``.

    Key dedupe works within one date; a match re-landed on a later date (a
    topic re-read after a restart) is removed here.  The seen keys are one
    bigint per match, deduplicated (partially, map-side) before the join; the
    planner broadcasts them while small and shuffles both sides otherwise.
    """
    keys = seen_keys.select(MATCH_KEY).dropDuplicates()
    return docs.join(keys, MATCH_KEY, "left_anti")


# The document fields each silver branch reads (pass to ``silver_input``).
GAME_INFO = [f for f, _ in GAME_FIELDS]
PARTICIPANT_INFO = ["participants"]
TEAM_INFO = ["teams"]
BRANCH_INFO = {"games": GAME_INFO, "participants": PARTICIPANT_INFO, "teams_stats": TEAM_INFO,
               "teams_bans": TEAM_INFO}


def games(docs: DataFrame) -> DataFrame:
    """silver.games: one row per match (L2), for input with one document per match."""
    out = [F.col(MATCH_KEY)] + [F.col("doc.info")[f].alias(o) for f, o in GAME_FIELDS[1:]]
    return docs.select(*out, "partition_date")


def distinct_games(docs: DataFrame) -> DataFrame:
    """silver.games by whole-row distinct (A5), for input that repeats documents."""
    return games(docs).dropDuplicates()


def participants(docs: DataFrame) -> DataFrame:
    """silver.participants: one row per participant, numbered 1..n per match.

    ``docs`` must hold one document per match (``silver_input``).
    """
    ex = docs.select(MATCH_KEY, "partition_date",
                  F.posexplode(F.sort_array(F.col("doc.info.participants"))).alias("pos", "p"))
    # No whole-row distinct (the reference's A5): the input holds one document
    # per match and posexplode numbers within it, so (match_id, participant_id)
    # is already unique and a distinct would only add an aggregate over every
    # column.
    return ex.select(
        MATCH_KEY, (F.col("pos") + 1).alias("participant_id"),
        *[F.col("p")[f].alias(o) for f, o in PARTICIPANT_OUTPUT],
        "partition_date")


def participants_by_window(docs: DataFrame) -> DataFrame:
    """The same table numbered by a ``row_number`` window over ``match_id``.

    Kept for inputs that arrive already flattened.  After ``dedupe_by_key``
    the rows are hash-partitioned by match_id, so the window adds a sort but
    no exchange.  The sort is by the participant itself, which compares field by field
    in document order: a copy of every field beside it would double the rows sorted.
    """
    from pyspark.sql import Window
    ex = docs.select(MATCH_KEY, "partition_date",
                     F.explode(F.col("doc.info.participants")).alias("p"))
    w = Window.partitionBy("partition_date", MATCH_KEY).orderBy(F.col("p").asc_nulls_first())
    return ex.select(
        MATCH_KEY, F.row_number().over(w).alias("participant_id"),
        *[F.col("p")[f].alias(o) for f, o in PARTICIPANT_OUTPUT],
        "partition_date")      # no distinct: the row number is unique within its match


def team_stats(docs: DataFrame) -> DataFrame:
    """silver.teams_stats: one row per team of a match (L4).

    Rows repeat only inside a document, so they are made distinct in its array,
    before the explode: no exchange after the key dedupe."""
    teams = F.transform(F.col("doc.info.teams"), lambda t: F.struct(
        t["teamId"].alias("team_id"), t["win"].alias("win"),
        *[t["objectives"][k]["kills"].alias(f"{k}_kills") for k in ("baron", "dragon", "tower")]))
    return docs.select(MATCH_KEY, "partition_date", F.inline(F.array_distinct(teams))).select(
        *TEAM_STAT_COLUMNS)


def team_bans(docs: DataFrame) -> DataFrame:
    """silver.teams_bans: team -> bans (L5), distinct inside the document as above."""
    bans = F.transform(F.col("doc.info.teams"), lambda t: F.transform(
        F.coalesce(t["bans"], F.array()), lambda b: F.struct(
            t["teamId"].alias("team_id"), b["pickTurn"].alias("ban_turn"),
            b["championId"].alias("champion_id"))))
    return docs.select(MATCH_KEY, "partition_date",
                       F.inline(F.array_distinct(F.flatten(bans)))).select(*TEAM_BAN_COLUMNS)


def document_overview(docs: DataFrame) -> DataFrame:
    """The full parse, summarised per match (P6/P7 check)."""
    return docs.select(
        MATCH_KEY,
        F.col("doc.metadata.matchId").alias("match_key"),
        F.col("doc.metadata.dataVersion").alias("data_version"),
        F.col("doc.info.gameMode").alias("game_mode"),
        F.size(F.coalesce("doc.info.participants", F.array())).alias("n_participants"),
        F.size(F.coalesce("doc.info.teams", F.array())).alias("n_teams"),
        F.size(F.coalesce("doc.metadata.participants", F.array())).alias("n_players"),
        "partition_date")


def player_rows(docs: DataFrame) -> DataFrame:
    """Participants carrying their player key: ``arrays_zip`` of
    ``metadata.participants`` and ``info.participants`` (same order)."""
    z = docs.select(MATCH_KEY, "partition_date",
                 F.explode(F.arrays_zip(F.col("doc.metadata.participants").alias("player"),
                                        F.col("doc.info.participants").alias("p"))).alias("z"))
    return z.select(MATCH_KEY, "partition_date", F.col("z.player").alias("player_key"),
                    F.col("z.p.kills").alias("kills"), F.col("z.p.deaths").alias("deaths"),
                    F.col("z.p.assists").alias("assists"))
