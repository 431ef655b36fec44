"""DuckDB oracle SQL for the enrichment chain, written against ``customer``,
``orders``, ``lineitem`` and ``events`` (players are customers, a player's
matches are its orders, a match's participants are the order's lines)."""

from __future__ import annotations

INGEST = "DATE '2024-02-01'"
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
SNAPSHOT_AT = "'2024-02-01T00:00:00.000000'"
DETAILS_AT = "'2024-02-01T00:00:02.000000'"
MATCH_AT = "'2024-02-01T00:00:03.000000'"

SEED_ENTRIES = f"""
select c_nationkey as region_key, c_custkey // 200 as page,
  {SNAPSHOT_AT} as timestamp_summoner, c_name as "summonerId"
from customer
"""

ENRICH_IDENTITY = f"""
select strftime(ts, {ISO}) as timestamp_summoner, c_name as "summonerId",
  'PU-' || cast(c_custkey as varchar) as puuid
from events join customer on c_custkey = user_id
"""

RECENT_N = """
select puuid, match_id, played_at, cast(recency as integer) as recency from (
  select 'PU-' || cast(o_custkey as varchar) as puuid,
    'BR1_' || cast(o_orderkey as varchar) as match_id,
    o_orderdate as played_at,
    row_number() over (partition by o_custkey
                       order by o_orderdate desc, 'BR1_' || cast(o_orderkey as varchar) desc) as recency
  from orders) r
where recency <= 5
"""

HISTORY = f"""
select c_name as "summonerId", r.match_id, cast(substring(r.match_id, 5) as bigint) as orderkey
from customer join ({RECENT_N}) r on r.puuid = 'PU-' || cast(c_custkey as varchar)
"""

ENRICH_HISTORY = f"""
select {SNAPSHOT_AT} as timestamp_summoner, "summonerId",
  {DETAILS_AT} as timestamp_summoner_details, match_id
from ({HISTORY}) h
"""

LINES_PER_ORDER = """
select o_orderkey, cast(count(l_orderkey) as integer) as n_participants
from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey
"""

ENRICH_DOCUMENT = f"""
select {SNAPSHOT_AT} as timestamp_summoner, "summonerId",
  {DETAILS_AT} as timestamp_summoner_details, match_id, {MATCH_AT} as timestamp_match,
  orderkey as game_id, n_participants
from ({HISTORY}) h join ({LINES_PER_ORDER}) c on c.o_orderkey = h.orderkey
"""

ENRICH_CHAIN = f"""
select {SNAPSHOT_AT} as timestamp_summoner, {DETAILS_AT} as timestamp_summoner_details,
  {MATCH_AT} as timestamp_match, {INGEST} as partition_date,
  orderkey as game_id, n_participants
from ({HISTORY}) h join ({LINES_PER_ORDER}) c on c.o_orderkey = h.orderkey
"""

ENRICH_RETRIES = f"""
select {SNAPSHOT_AT} as timestamp_summoner, c_name as "summonerId",
  cast(null as varchar) as match_id, 'no_history' as reason
from customer where c_custkey not in (select o_custkey from orders)
union all
select {SNAPSHOT_AT}, s_name, cast(null as varchar), 'unknown_player'
from supplier where s_name not in (select c_name from customer)
union all
select {SNAPSHOT_AT}, 'Part#' || cast(p_partkey as varchar), cast(null as varchar), 'no_history'
from part
union all
select {SNAPSHOT_AT}, n_name, 'GONE_' || cast(n_nationkey as varchar), 'no_document'
from nation
"""

RETRY_REDRIVE = """
select s_name as "summonerId", 'unknown_player' as reason, 3 as attempts, 'dead' as status,
  cast(0 as bigint) as matches, true as in_dead from supplier
union all
select 'Part#' || cast(p_partkey as varchar), 'no_history', 3,
  case when p_partkey % 2 = 0 then 'sent' else 'dead' end,
  case when p_partkey % 2 = 0 then 1 else 0 end, p_partkey % 2 <> 0 from part
union all
select n_name, 'unknown_player', 2, 'sent', 1, false from nation
"""
