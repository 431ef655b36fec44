"""Fixed, hand-written schemas (never inferred from JSON).

The envelope is what one message on the ``matchs`` topic holds; the match
document is the nested object carried in its ``match_details`` field.  All
fields are nullable; fields not declared are dropped when parsing.

Fixed values: the field names, nesting and types below (and the topic name
``matchs``) are the message and document formats the pipeline consumes, so
they must equal the producers' formats exactly.  They are listed in the
documents' own order.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType,
                               LongType, MapType, StringType, StructField,
                               StructType, TimestampType)


def _s(name, dtype):
    return StructField(name, dtype, True)


# --- message envelopes -----------------------------------------------------

SEED_SCHEMA = StructType([_s("timestamp_summoner", StringType()),
                          _s("summonerId", StringType())])

DETAIL_SCHEMA = StructType(SEED_SCHEMA.fields + [
    _s("timestamp_summoner_details", StringType()), _s("match_id", StringType())])

# As read by the bronze ingest: the nested document is declared a string, so
# it lands as its raw JSON text.
ENVELOPE_SCHEMA = StructType([
    _s("timestamp_summoner", StringType()),
    _s("timestamp_summoner_details", StringType()),
    _s("timestamp_match", StringType()),
    _s("match_details", StringType()),
])

BRONZE_COLUMNS = ["timestamp_summoner", "timestamp_summoner_details",
                  "timestamp_match", "match_details", "partition_date"]

STAGE_COLUMNS = {"summoner": "timestamp_summoner",
                 "summoner_details": "timestamp_summoner_details",
                 "match": "timestamp_match"}

SNAPSHOT_SCHEMA = StructType([
    _s("entries", ArrayType(StructType([_s("summonerId", StringType())])))])

# --- match document --------------------------------------------------------

PARTICIPANT_TYPE = StructType([
    _s("championId", IntegerType()),
    _s("championName", StringType()),
    _s("teamId", IntegerType()),
    _s("individualPosition", StringType()),
    _s("lane", StringType()),
    _s("kills", IntegerType()),
    _s("deaths", IntegerType()),
    _s("assists", IntegerType()),
    _s("totalDamageDealt", IntegerType()),
    _s("totalDamageTaken", IntegerType()),
    _s("goldEarned", IntegerType()),
    _s("win", StringType()),
    _s("item0", IntegerType()),
    _s("item1", IntegerType()),
    _s("item2", IntegerType()),
    _s("item3", IntegerType()),
    _s("item4", IntegerType()),
    _s("item5", IntegerType()),
    _s("item6", IntegerType()),
    _s("allInPings", IntegerType()),
    _s("itemsPurchased", IntegerType()),
    _s("wardsKilled", IntegerType()),
    _s("wardsPlaced", IntegerType()),
])

_KILLS = StructType([_s("kills", IntegerType())])

TEAM_TYPE = StructType([
    _s("teamId", IntegerType()),
    _s("win", StringType()),
    _s("objectives", StructType([_s("baron", _KILLS), _s("dragon", _KILLS),
                                 _s("tower", _KILLS)])),
    _s("bans", ArrayType(StructType([_s("pickTurn", IntegerType()),
                                     _s("championId", IntegerType())]))),
])

INFO_SCALARS = [
    _s("gameId", LongType()),
    _s("gameCreation", LongType()),
    _s("gameDuration", IntegerType()),
    _s("gameMode", StringType()),
    _s("gameVersion", StringType()),
    _s("mapId", IntegerType()),
    _s("queueId", IntegerType()),
    _s("platformId", StringType()),
    _s("gameStartTimestamp", LongType()),
    _s("gameEndTimestamp", LongType()),
]

METADATA_TYPE = StructType([
    _s("dataVersion", StringType()),
    _s("matchId", StringType()),
    _s("participants", ArrayType(StringType())),
])

DOCUMENT_SCHEMA = StructType([
    _s("metadata", METADATA_TYPE),
    _s("info", StructType(INFO_SCALARS + [
        _s("participants", ArrayType(PARTICIPANT_TYPE)),
        _s("teams", ArrayType(TEAM_TYPE)),
    ])),
])


def document_schema(info_fields: list[str] | None = None,
                    with_metadata: bool = False) -> StructType:
    """The document schema pruned to the ``info`` fields a branch needs.

    Spark prunes unused top-level fields of ``from_json`` by itself but not
    fields below a nested struct, so each silver branch passes its own subset;
    the JSON reader then skips the other subtrees without materialising them.
    """
    info = DOCUMENT_SCHEMA["info"].dataType
    keep = info.fields if info_fields is None else [
        f for f in info.fields if f.name in set(info_fields)]
    fields = [_s("info", StructType(keep))]
    if with_metadata or info_fields is None:
        fields.insert(0, _s("metadata", METADATA_TYPE))
    return StructType(fields)


# --- metric samples --------------------------------------------------------

METRIC_SCHEMA = StructType([
    _s("metric", StringType()),
    _s("labels", MapType(StringType(), StringType())),
    _s("ts", TimestampType()),
    _s("value", DoubleType()),
])

# A match message summarised: its key and how many participants it carries
# (one parse, nothing else materialised).
DOCUMENT_SUMMARY_SCHEMA = StructType([_s("info", StructType([
    _s("gameId", LongType()),
    _s("participants", ArrayType(StructType([_s("championId", IntegerType())])))]))])

__all__ = [n for n in dir() if n.isupper() or n == "document_schema"]
