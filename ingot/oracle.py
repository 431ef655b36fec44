"""DuckDB oracle SQL, written straight against the driver's tables.

The oracle never shares code with the Spark side: it re-derives each expected
result from ``orders``/``lineitem``/``events``/``customer`` with the fixed
mapping in ``ingot.sources.fixtures`` (restated here as SQL).
"""

from __future__ import annotations

INGEST = "DATE '2024-02-01'"

# One silver participant per lineitem (the document fixture's mapping).
PARTICIPANT_ROWS = f"""
select l_orderkey as match_id,
  cast(l_partkey as integer) as champion_id,
  l_returnflag as champion_name,
  case when l_linenumber % 2 = 1 then 100 else 200 end as team_id,
  ['TOP','JUNGLE','MIDDLE','BOTTOM','UTILITY'][l_linenumber % 5 + 1] as individual_position,
  ['TOP','JUNGLE','MIDDLE','BOTTOM','BOTTOM'][l_linenumber % 5 + 1] as lane,
  cast(trunc(l_quantity) as integer) as kills,
  l_linenumber as deaths,
  cast(l_suppkey % 30 as integer) as assists,
  cast(trunc(l_extendedprice * 10) as integer) as total_damage_dealt,
  cast(trunc(l_extendedprice * l_discount * 100) as integer) as total_damage_taken,
  cast(trunc(l_extendedprice) as integer) as gold_earned,
  case when l_linestatus = 'F' then 'true' else 'false' end as win,
  {", ".join(f"cast((l_partkey + {k} * l_suppkey) % 7000 as integer) as item{k}" for k in range(7))},
  cast(l_linenumber % 3 as integer) as "allInPings",
  cast(l_suppkey % 20 as integer) + l_linenumber as "itemsPurchased",
  cast(l_partkey % 9 as integer) as "wardsKilled",
  cast(l_partkey % 13 as integer) as "wardsPlaced",
  'P' || cast(l_suppkey as varchar) as player_key
from lineitem
"""

PARTICIPANT_ORDER = ("champion_id, champion_name, team_id, individual_position, lane, kills, "
                     "deaths, assists, total_damage_dealt, total_damage_taken, gold_earned, win, "
                     + ", ".join(f"item{k}" for k in range(7))
                     + ', "allInPings", "itemsPurchased", "wardsKilled", "wardsPlaced"')

PARTICIPANT_SELECT = ("match_id, participant_id, champion_id, champion_name, team_id, "
                      "individual_position, lane, kills, deaths, assists, "
                      + ", ".join(f"item{k}" for k in range(7))
                      + ', "allInPings", "itemsPurchased", "wardsKilled", "wardsPlaced", '
                      "total_damage_dealt, total_damage_taken, gold_earned, win, partition_date")

NUMBERED = f"""
numbered as (
  select *, cast(row_number() over (partition by match_id order by {PARTICIPANT_ORDER}) as integer)
         as participant_id, {INGEST} as partition_date
  from ({PARTICIPANT_ROWS}) p)
"""

PARTICIPANTS = f"with {NUMBERED} select {PARTICIPANT_SELECT} from numbered"

GAMES = f"""
select o_orderkey as match_id,
  epoch_ms(o_orderdate) as game_creation,
  cast(cast(trunc(o_totalprice) as bigint) % 3600 as integer) as game_duration,
  o_orderstatus as game_mode,
  o_orderpriority as game_version,
  cast(o_custkey % 20 as integer) as map_id,
  cast(o_custkey % 7 as integer) as queue_id,
  'BR1' as platform_id,
  epoch_ms(o_orderdate) + 60000 as game_start_timestamp,
  epoch_ms(o_orderdate) + 1860000 as game_end_timestamp,
  {INGEST} as partition_date
from orders
"""

TEAM_LINES = """
select *, case when l_linenumber % 2 = 1 then 100 else 200 end as team_id from lineitem
"""

TEAM_STATS = f"""
select l_orderkey as match_id, team_id,
  case when bool_or(l_linestatus = 'F') then 'true' else 'false' end as win,
  cast(count(*) filter (where l_returnflag = 'R') as integer) as baron_kills,
  cast(count(*) filter (where l_returnflag = 'A') as integer) as dragon_kills,
  cast(count(*) filter (where l_returnflag = 'N') as integer) as tower_kills,
  {INGEST} as partition_date
from ({TEAM_LINES}) t group by l_orderkey, team_id
"""

TEAM_BANS = f"""
select distinct l_orderkey as match_id, team_id, l_linenumber as ban_turn,
  cast(l_suppkey as integer) as champion_id, {INGEST} as partition_date
from ({TEAM_LINES}) t
"""

DOCUMENT_OVERVIEW = f"""
select o_orderkey as match_id, 'BR1_' || cast(o_orderkey as varchar) as match_key,
  '2' as data_version, o_orderstatus as game_mode,
  cast(coalesce(n, 0) as integer) as n_participants,
  cast(coalesce(nt, 0) as integer) as n_teams,
  cast(coalesce(n, 0) as integer) as n_players,
  {INGEST} as partition_date
from orders left join (
  select l_orderkey, count(*) as n, count(distinct l_linenumber % 2) as nt
  from lineitem group by l_orderkey) c on c.l_orderkey = o_orderkey
"""

MATCH_SUMMARY = GAMES

PLAYER_PERFORMANCE = f"""
with {NUMBERED}
select match_id, participant_id, champion_id, champion_name, team_id, partition_date,
  sum(kills)::bigint as total_kills, sum(deaths)::bigint as total_deaths,
  sum(assists)::bigint as total_assists,
  sum(total_damage_dealt)::bigint as total_damage_dealt,
  sum(total_damage_taken)::bigint as total_damage_taken,
  sum(gold_earned)::bigint as total_gold_earned,
  sum("wardsPlaced")::bigint as wards_placed, sum("wardsKilled")::bigint as wards_killed,
  sum("itemsPurchased")::bigint as items_purchased,
  max(win) as win_status
from numbered group by all
"""

TEAM_PERFORMANCE = f"""
select match_id, team_id, partition_date, max(win) as win_status,
  sum(baron_kills)::bigint as total_baron_kills, sum(dragon_kills)::bigint as total_dragon_kills,
  sum(tower_kills)::bigint as total_tower_kills
from ({TEAM_STATS}) s group by all
"""

PLAYER_TOTALS = f"""
select player_key, count(*) as appearances, sum(kills)::bigint as total_kills,
  sum(deaths)::bigint as total_deaths, sum(assists)::bigint as total_assists
from ({PARTICIPANT_ROWS}) p group by player_key
"""

# The damaged document fixture: every tenth cut short, else every eleventh null, else
# every thirteenth empty; every third landed twice.  Bad rows are all kept.
SILVER_QUARANTINE = """
with landed as (
  select o_orderkey, o_orderdate,
    case when o_orderkey % 10 = 0 then 'cut' when o_orderkey % 11 = 0 then 'null'
         when o_orderkey % 13 = 0 then 'empty' end as damage,
    unnest(range(case when o_orderkey % 3 = 0 then 2 else 1 end)) as copy
  from orders)
select cast(null as bigint) as match_id,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') as timestamp_summoner, damage
from landed where damage is not null
union all
select distinct o_orderkey, null, null from landed where damage is null
"""
