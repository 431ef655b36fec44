"""Gold operators: roll silver tables up.

Every aggregate here is decomposable (sum / max / count), so Spark combines
map-side before the exchange; a hot group key costs one partial row per task.
``win`` is a string, so ``max`` is lexicographic: ``'true' > 'false'``, i.e. a
logical OR over the group (quirk Q2, kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import GAME_COLUMNS

PLAYER_KEYS = ["match_id", "participant_id", "champion_id", "champion_name", "team_id",
               "partition_date"]
PLAYER_SUMS = [("kills", "total_kills"), ("deaths", "total_deaths"),
               ("assists", "total_assists"), ("total_damage_dealt", "total_damage_dealt"),
               ("total_damage_taken", "total_damage_taken"),
               ("gold_earned", "total_gold_earned"), ("wardsPlaced", "wards_placed"),
               ("wardsKilled", "wards_killed"), ("itemsPurchased", "items_purchased")]
PLAYER_INPUT = [*PLAYER_KEYS, *[c for c, _ in PLAYER_SUMS], "win"]
TEAM_KEYS = ["match_id", "team_id", "partition_date"]
TEAM_SUMS = [("baron_kills", "total_baron_kills"), ("dragon_kills", "total_dragon_kills"),
             ("tower_kills", "total_tower_kills")]
TEAM_INPUT = [*TEAM_KEYS, "win", *[c for c, _ in TEAM_SUMS]]


def match_summary(games: DataFrame) -> DataFrame:
    """gold.match_summary: the games columns, whole-row distinct (A5)."""
    return games.select(*GAME_COLUMNS).dropDuplicates()


def player_performance(participants: DataFrame) -> DataFrame:
    """gold.player_performance: nine sums and the win flag per participant (A1, A2).

    No trailing distinct: rows of a group-by are already unique.
    """
    return participants.groupBy(*PLAYER_KEYS).agg(
        *[F.sum(c).alias(o) for c, o in PLAYER_SUMS],
        F.max("win").alias("win_status"))


def team_performance(team_stats: DataFrame) -> DataFrame:
    """gold.team_performance: win flag and three sums per team (A3)."""
    return team_stats.groupBy(*TEAM_KEYS).agg(
        F.max("win").alias("win_status"),
        *[F.sum(c).alias(o) for c, o in TEAM_SUMS])


def player_totals(player_rows: DataFrame) -> DataFrame:
    """KPI totals per player across matches (R1): kills, deaths, assists."""
    return player_rows.groupBy("player_key").agg(
        F.count(F.lit(1)).alias("appearances"),
        F.sum("kills").alias("total_kills"),
        F.sum("deaths").alias("total_deaths"),
        F.sum("assists").alias("total_assists"))
