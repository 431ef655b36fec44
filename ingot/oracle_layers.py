"""DuckDB oracle SQL for the bronze layer and table mechanics.

Written straight against ``events``: the stage times and message text are
re-derived here from the fixed mapping in ``ingot.sources.fixtures`` (detail
stage = ts + event_id % 97 s; match stage = detail + user_id % 113 s, absent
for ``error`` events; document = ``{"k":<k>}``).
"""

from __future__ import annotations

INGEST = "DATE '2024-02-01'"
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

STAGES = f"""
select event_id, ts, user_id, event_type,
  strftime(ts, {ISO}) as timestamp_summoner,
  strftime(ts + to_seconds(event_id % 97), {ISO}) as timestamp_summoner_details,
  case when event_type <> 'error'
       then strftime(ts + to_seconds(event_id % 97 + user_id % 113), {ISO}) end as timestamp_match,
  '{{"k":' || cast(json_extract(props, '$.k') as bigint) || '}}' as match_details
from events
"""

BRONZE_COLS = ("timestamp_summoner, timestamp_summoner_details, timestamp_match, "
               "match_details")

BRONZE = f"select {BRONZE_COLS}, {INGEST} as partition_date from ({STAGES}) s"

BRONZE_KEYED = f"select event_id as key, {BRONZE_COLS}, {INGEST} as partition_date from ({STAGES}) s"

# The message text as the producer serialises it (fields in order, nulls omitted).
MESSAGE_TEXT = """
'{"timestamp_summoner":"' || timestamp_summoner
  || '","timestamp_summoner_details":"' || timestamp_summoner_details || '"'
  || coalesce(',"timestamp_match":"' || timestamp_match || '"', '')
  || ',"match_details":' || match_details || '}'
"""

QUARANTINE = f"""
select event_id as key, substring(msg, 1, length(msg) - 7) as raw_message,
  {INGEST} as partition_date
from (select event_id, {MESSAGE_TEXT} as msg from ({STAGES}) s) m
where event_id % 10 = 0
"""

EVENTS_ROUNDTRIP = "select event_id, ts, user_id, event_type, value, props from events"

BY_DAY = f"select {BRONZE_COLS}, cast(ts as date) as partition_date, event_id from ({STAGES}) s"

BRONZE_SCAN = f"""
select {BRONZE_COLS}, partition_date from ({BY_DAY}) b
where partition_date = DATE '2024-01-15'
"""

BRONZE_RERUN = f"""
select {BRONZE_COLS}, partition_date from ({BY_DAY}) b
union all
select {BRONZE_COLS}, partition_date from ({BY_DAY}) b
where event_id % 3 = 0
  and partition_date not between DATE '2024-01-10' and DATE '2024-01-12'
"""

BRONZE_RETAINED = f"""
select {BRONZE_COLS}, partition_date from ({BY_DAY}) b
where partition_date >= DATE '2024-01-20'
"""

# Every message of the odd fixture once per copy: bad ones with their text, else as bronze.
QUARANTINE_STREAM = f"""
with sent as (
  select s.*, {MESSAGE_TEXT} as msg,
    case when event_id % 10 = 0 then 'cut' when event_id % 11 = 0 then 'null'
         when event_id % 13 = 0 then 'blank' when event_id % 17 = 0 then 'other' end as odd,
    unnest(range(case when event_id % 3 = 0 then 2 else 1 end)) as copy
  from ({STAGES}) s)
select 'bronze' as landed, cast(null as bigint) as key,
  case when odd is null then timestamp_summoner end as timestamp_summoner,
  case when odd is null then timestamp_summoner_details end as timestamp_summoner_details,
  case when odd is null then timestamp_match end as timestamp_match,
  case when odd is null then match_details end as match_details,
  cast(null as varchar) as raw_message
from sent where odd is null or odd = 'other'
union all
select 'quarantine', event_id, null, null, null, null,
  case odd when 'cut' then substring(msg, 1, length(msg) - 7) when 'blank' then '  ' end
from sent where odd in ('cut', 'null', 'blank')
"""

# Each key once, and the second run's replays older than a day before the newest event.
BRONZE_LATE = f"""
select false as late, event_id as key, {BRONZE_COLS}, {INGEST} as partition_date
from ({STAGES}) s
union all
select true, event_id, {BRONZE_COLS}, {INGEST} from ({STAGES}) s
where event_id % 5 = 0 and ts < (select max(ts) from events) - interval 1 day
"""
