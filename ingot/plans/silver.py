"""Silver and gold layers: the daily jobs (L2-L8) and their registered queries.

The jobs read one date of the layer below by the table root + a partition
filter, take that date through (no ``current_date()`` re-stamping, quirk Q6)
and overwrite only that date in each output (dynamic partition overwrite,
quirk Q5).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle
from ..functions.schemas import STAGE_COLUMNS
from ..operators import documents as D
from ..operators import rollups as R
from ..registry import query
from ..session import fresh_path, path_exists, pin_session
from ..sources.fixtures import (
    INGEST_DATE,
    damaged_bronze,
    landed_bronze_matches,
    landed_bronze_matches_root,
)
from ..sources.sinks import (
    bucket_layout,
    clustered,
    drop_partition,
    is_published,
    overwrite_partitions,
    replace_date,
    replace_dates,
)
from ..sources.tables import as_date, read_layer, read_layer_if_present


DOCUMENTS_PER_BUCKET = 250_000      # parsed, about 400 MB in the sort that finds the survivors
ROWS_PER_BUCKET = 2_000_000         # of a silver table, about 300 MB in the roll-up's sort


def run_bronze_to_silver(spark: SparkSession, bronze_path: str, out: dict[str, str],
                         partition_date, quarantine_path: str | None = None,
                         skip_seen: bool = False, look_back_days: int = 30) -> None:
    """The daily bronze -> silver job for one date.

    Each document is parsed once (the fields that the tables in ``out`` read) and written once
    as Parquet below the shared folder, in buckets of its match, without a shuffle.  The
    deduplication reads that table by bucket and notes the rows that survive.  Each of the four
    branches and the quarantine reads its own columns of these rows (a lost executor costs no
    recomputation above the table), adds no exchange, and the table is removed at the end.

    Documents that do not parse are kept, each one, with their stage times, in
    the quarantine (by default next to ``games``).  ``skip_seen`` drops matches that
    silver ``games`` already holds under one of the ``look_back_days`` dates before,
    so a match re-landed days later is not counted twice; the look-back bounds
    what a run reads of the history.  The tables' dates are replaced together
    (``replace_dates``): a run that fails leaves the old date whole, or unmarked.
    """
    pin_session(spark)
    date = as_date(partition_date)
    day = F.lit(date)
    quarantine_path = quarantine_path or (
        f"{next(iter(out.values())).rstrip('/')}_quarantine")
    fields = [f for name, read in D.BRANCH_INFO.items() if name in out for f in read]
    bronze = read_layer(spark, bronze_path, partition_date)
    times = [c for c in STAGE_COLUMNS.values() if c in bronze.columns]
    # Bad rows have no match: they spread over the buckets by their own numbers.
    keyed = D.key_unparsed(D.with_match_key(bronze, fields)).select(
        *times, D.MATCH_KEY, "doc", "_raw", "_bad", "_bad_id",
        F.coalesce(D.MATCH_KEY, "_bad_id").alias("_cluster"),
        F.monotonically_increasing_id().alias("_row"))
    layout = bucket_layout(spark, bronze.count(), DOCUMENTS_PER_BUCKET)
    with clustered(keyed, "_cluster", "documents", *layout) as rows:
        payload = F.struct("doc", "_raw", "_bad", "_row")
        # One date only: no need to group by it.
        best = D.dedupe_by_key(rows.withColumn("_payload", payload), "_payload",
                               by=("_bad_id", "_cluster"))
        best = best.select(D.MATCH_KEY, "_cluster", F.col("_payload._row").alias("_best"))
        if skip_seen and "games" in out and path_exists(spark, out["games"]):
            earlier = read_layer_if_present(spark, out["games"])
            if earlier is not None:
                since = F.lit(date - dt.timedelta(days=look_back_days))
                best = D.drop_seen(best, earlier.where(
                    (F.col("partition_date") < day) & (F.col("partition_date") >= since)))
        builders = {"games": D.games, "participants": D.participants,
                    "teams_stats": D.team_stats, "teams_bans": D.team_bans}
        with clustered(best.drop(D.MATCH_KEY), "_cluster", "survivors", *layout) as survivors:
            def surviving(which: str, *columns) -> DataFrame:
                # Buckets serve a join by all its keys only, so the row's number is no key of it.
                mine = rows.where(which).select(F.col("_cluster").alias("_of"), "_row", *columns)
                same = F.col("_row").between(F.col("_best"), F.col("_best"))
                return mine.join(survivors, (F.col("_of") == F.col("_cluster")) & same, "left_semi"
                                 ).drop("_of", "_row").withColumn("partition_date", day)

            def documents(name: str) -> DataFrame:
                info = F.struct(*[F.col("doc.info")[f].alias(f) for f in D.BRANCH_INFO[name]])
                return surviving("NOT _bad", D.MATCH_KEY, F.struct(info.alias("info")).alias("doc"))
            replace_dates({quarantine_path: surviving(
                "_bad", *times, F.col("_raw").alias("match_details")),
                **{out[name]: build(documents(name)) for name, build in builders.items()
                   if name in out}}, date)


def run_silver_to_gold(spark: SparkSession, silver: dict[str, str], out: dict[str, str],
                       partition_date) -> None:
    """The daily silver -> gold job for one date.

    Each gold table's date is replaced by the roll-up of that date's silver
    rows; when silver holds none, the gold date is emptied rather than left with
    stale rows.  A silver root that does not exist is an error, and so is a date that the
    silver job began to replace and did not finish.
    """
    pin_session(spark)
    day = as_date(partition_date)
    plans = {"match_summary": ("games", R.match_summary, R.GAME_COLUMNS),
             "player_performance": ("participants", R.player_performance, R.PLAYER_INPUT),
             "team_performance": ("teams_stats", R.team_performance, R.TEAM_INPUT)}
    for name, (source, rollup, columns) in plans.items():
        if name not in out:
            continue
        rows = read_layer_if_present(spark, silver[source], day)
        if not is_published(spark, silver[source], day):
            raise ValueError(f"{day} of {silver[source]} is not published: run bronze-to-silver")
        if rows is None:
            drop_partition(spark, out[name], day)
        else:
            # Groups hold one match's rows, so rows in buckets of it need no shuffle.
            rows = rows.select(*columns)
            layout = bucket_layout(spark, rows.count(), ROWS_PER_BUCKET)
            with clustered(rows, "match_id", name, *layout) as here:
                # a group-by of non-empty rows is never empty: probe the scan,
                # not the aggregate (which would run twice)
                replace_date(rollup(here), out[name], day, probe=rows)


# ---------------------------------------------------------------------------
# Registered queries (document fixture built from orders + lineitem)
# ---------------------------------------------------------------------------

def _docs(spark, sf_dir, info_fields=None, with_metadata=False, duplicates=False):
    pin_session(spark)
    return D.silver_input(landed_bronze_matches(spark, sf_dir, duplicates),
                          info_fields, with_metadata)


@query("parse_document", oracle.DOCUMENT_OVERVIEW)
def q_parse_document(spark, sf_dir):
    return D.document_overview(_docs(spark, sf_dir))


@query("games", oracle.GAMES)
def q_games(spark, sf_dir):
    return D.games(_docs(spark, sf_dir, D.GAME_INFO))


@query("participants", oracle.PARTICIPANTS)
def q_participants(spark, sf_dir):
    return D.participants(_docs(spark, sf_dir, D.PARTICIPANT_INFO))


@query("participants_window", oracle.PARTICIPANTS)
def q_participants_window(spark, sf_dir):
    return D.participants_by_window(_docs(spark, sf_dir, D.PARTICIPANT_INFO))


@query("team_stats", oracle.TEAM_STATS)
def q_team_stats(spark, sf_dir):
    return D.team_stats(_docs(spark, sf_dir, D.TEAM_INFO))


@query("team_bans", oracle.TEAM_BANS)
def q_team_bans(spark, sf_dir):
    return D.team_bans(_docs(spark, sf_dir, D.TEAM_INFO))


@query("dedupe_rows", oracle.GAMES)
def q_dedupe_rows(spark, sf_dir):
    """Every third document landed twice; whole-row distinct alone (A5) suffices
    for games, whose rows carry no numbering."""
    pin_session(spark)
    bronze = landed_bronze_matches(spark, sf_dir, True)
    ok, _ = D.split_by_key(D.with_match_key(bronze, D.GAME_INFO))
    return D.distinct_games(ok)


@query("dedupe_by_key", oracle.PARTICIPANTS)
def q_dedupe_by_key(spark, sf_dir):
    """Every third document landed twice; deduplicating by match key before
    the explode keeps ids 1..n (the fix for quirk Q3)."""
    return D.participants(_docs(spark, sf_dir, D.PARTICIPANT_INFO, duplicates=True))


@query("match_summary", oracle.MATCH_SUMMARY)
def q_match_summary(spark, sf_dir):
    return R.match_summary(D.games(_docs(spark, sf_dir, D.GAME_INFO)))


@query("player_performance", oracle.PLAYER_PERFORMANCE)
def q_player_performance(spark, sf_dir):
    return R.player_performance(D.participants(_docs(spark, sf_dir, D.PARTICIPANT_INFO)))


@query("team_performance", oracle.TEAM_PERFORMANCE)
def q_team_performance(spark, sf_dir):
    return R.team_performance(D.team_stats(_docs(spark, sf_dir, D.TEAM_INFO)))


@query("player_totals", oracle.PLAYER_TOTALS)
def q_player_totals(spark, sf_dir):
    return R.player_totals(D.player_rows(_docs(spark, sf_dir, D.PARTICIPANT_INFO,
                                              with_metadata=True)))


@query("silver_quarantine", oracle.SILVER_QUARANTINE)
def q_silver_quarantine(spark, sf_dir):
    """The daily silver job on documents of which every tenth is cut short, every
    eleventh null, every thirteenth empty, and every third landed twice: each
    bad row in the quarantine with its stage time, each good match once in
    ``games``."""
    pin_session(spark)
    bronze, games = fresh_path(spark, "bronze-bad"), fresh_path(spark, "silver-good")
    overwrite_partitions(damaged_bronze(spark, sf_dir), bronze)
    run_bronze_to_silver(spark, bronze, {"games": games}, INGEST_DATE)
    bad = read_layer(spark, f"{games}_quarantine", INGEST_DATE)
    good = read_layer(spark, games, INGEST_DATE)
    text = F.col("match_details")
    damage = F.when(text.isNull(), "null").when(text == "", "empty").otherwise("cut")
    nothing = F.lit(None).cast("string")
    return bad.select(F.lit(None).cast("long").alias("match_id"), "timestamp_summoner",
                      damage.alias("damage")).unionByName(
        good.select("match_id", nothing.alias("timestamp_summoner"), nothing.alias("damage")))


@query("daily_bronze_to_gold", oracle.PLAYER_PERFORMANCE)
def q_daily_bronze_to_gold(spark, sf_dir):
    """L2-L8 as the daily jobs run them: bronze (every third document landed
    twice) -> four silver tables -> three gold tables for one date, each a
    partitioned table under the shared folder; gold player performance is
    read back from its table root."""
    pin_session(spark)
    bronze_root = landed_bronze_matches_root(spark, sf_dir, duplicates=True)
    silver = {k: fresh_path(spark, f"silver-{k}")
              for k in ("games", "participants", "teams_stats", "teams_bans")}
    gold = {k: fresh_path(spark, f"gold-{k}")
            for k in ("match_summary", "player_performance", "team_performance")}
    run_bronze_to_silver(spark, bronze_root, silver, INGEST_DATE,
                         quarantine_path=fresh_path(spark, "silver-quarantine"))
    run_silver_to_gold(spark, silver, gold, INGEST_DATE)
    return read_layer(spark, gold["player_performance"], INGEST_DATE)
