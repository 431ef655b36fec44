"""DuckDB oracle SQL for monitoring, written against ``events``.

Stage times follow the fixture mapping (detail = ts + event_id % 97 s, match =
detail + user_id % 113 s, none for ``error`` events); a metric series is
(event_type, user_id % 3).
"""

from __future__ import annotations

STAGE_ROWS = """
select ts as t_summoner, ts + to_seconds(event_id % 97) as t_details,
  case when event_type <> 'error' then ts + to_seconds(event_id % 97 + user_id % 113) end as t_match
from events
"""

STAGE_MINUTES = f"""
select date_trunc('minute', t_summoner) as minute, 'summoner' as stage from ({STAGE_ROWS}) s
union all
select date_trunc('minute', t_details), 'summoner_details' from ({STAGE_ROWS}) s
union all
select date_trunc('minute', t_match), 'match' from ({STAGE_ROWS}) s where t_match is not null
"""

STAGE_THROUGHPUT = f"""
select minute,
  count(*) filter (where stage = 'summoner') as summoner,
  count(*) filter (where stage = 'summoner_details') as summoner_details,
  count(*) filter (where stage = 'match') as "match"
from ({STAGE_MINUTES}) m group by minute
"""

STAGE_EVENTS = f"""
select distinct 'summoner' as stage, t_summoner as t from ({STAGE_ROWS}) s
union
select distinct 'summoner_details', t_details from ({STAGE_ROWS}) s
union
select distinct 'match', t_match from ({STAGE_ROWS}) s where t_match is not null
"""

STAGE_THROUGHPUT_DISTINCT = f"""
select date_trunc('minute', t) as minute,
  count(*) filter (where stage = 'summoner') as summoner,
  count(*) filter (where stage = 'summoner_details') as summoner_details,
  count(*) filter (where stage = 'match') as "match"
from ({STAGE_EVENTS}) e group by date_trunc('minute', t)
"""

THROUGHPUT_LONG = f"""
select minute, 'summoner' as stage, summoner as value from ({STAGE_THROUGHPUT}) w
union all select minute, 'summoner_details', summoner_details from ({STAGE_THROUGHPUT}) w
union all select minute, 'match', "match" from ({STAGE_THROUGHPUT}) w
"""

STAGE_LATENCY = f"""
with h as (
  select date_trunc('hour', t_summoner) as hour, 'summoner->summoner_details' as hop,
    epoch_us(t_details) - epoch_us(t_summoner) as us from ({STAGE_ROWS}) s
  union all
  select date_trunc('hour', t_details), 'summoner_details->match',
    epoch_us(t_match) - epoch_us(t_details) from ({STAGE_ROWS}) s where t_match is not null)
select hour, hop, count(*) as n, round(avg(us / 1e6), 3) as avg_seconds,
  quantile_disc(us / 1e6, 0.5) as p50_seconds, quantile_disc(us / 1e6, 0.95) as p95_seconds,
  max(us / 1e6) as max_seconds
from h group by hour, hop
"""

SAMPLES = """
select ts, event_type as topic, cast(user_id % 3 as varchar) as "partition", value,
  upper(event_type) as state
from events
"""

METRIC_SELECT = """
select ts, cast(user_id % 3 as varchar) as "partition", value from events
where event_type = 'purchase'
"""

METRIC_RECENT = f"""
select ts, topic, "partition", value from ({SAMPLES}) s
where ts > (select max(ts) from events) - interval 6 hours
"""

METRIC_GAUGE_MB = f"""
select ts, topic, "partition", value / 1024 / 1024 as value_mb from ({SAMPLES}) s
"""

METRIC_LEGEND = f"""
select ts, topic || ' p' || "partition" as legend, state, value from ({SAMPLES}) s
"""

DELTAS = f"""
select ts, topic, "partition",
  (value - first_value(value) over w) / 60.0 as d
from ({SAMPLES}) s
window w as (partition by topic, "partition" order by ts
             range between interval 60 minutes preceding and current row)
"""

METRIC_DELTA = f"""
select ts, topic, "partition", round(d, 6) as delta_per_min from ({DELTAS}) x
"""

METRIC_RATE = f"""
with l as (
  select *, lag(value) over (partition by topic, "partition" order by ts) as pv
  from ({SAMPLES}) s),
i as (
  select *, case when pv is null then 0.0 when value < pv then value else value - pv end as inc
  from l)
select ts, topic, "partition", round((sum(inc) over w - first_value(inc) over w) / 3600.0, 6) as rate
from i
window w as (partition by topic, "partition" order by ts
             range between interval 60 minutes preceding and current row)
"""

GRID_POINTS = f"""
select topic, "partition", ts, value,
  case when ts = date_trunc('minute', ts) then ts
       else date_trunc('minute', ts) + interval 1 minute end + to_minutes(k) as t
from (select *, unnest(range(60)) as k from ({SAMPLES}) s) e
"""

METRIC_MESSAGES_PER_MINUTE_GRID = f"""
select topic, t, round(sum(d), 6) as messages_per_min from (
  select topic, "partition", t, (arg_max(value, ts) - arg_min(value, ts)) / 60.0 as d
  from ({GRID_POINTS}) g group by topic, "partition", t having count(*) >= 2) x
group by topic, t
"""

METRIC_HEAP = """
select ts, 'node-' || cast(user_id % 2 as varchar) as instance,
  sum(value * 1000000) / 1048576 as used_mb,
  sum(value * 1000000 + 500000000) / 1048576 as max_mb
from events where event_type <> 'error' group by all
"""

BYTE_SAMPLES = """
select 'broker-' || cast(user_id % 2 as varchar) as instance, ts, event_id * 10.0 as i,
  event_id * 7.0 as o
from events
"""

BYTE_POINTS = f"""
select instance, ts, i, o,
  case when ts = date_trunc('minute', ts) then ts
       else date_trunc('minute', ts) + interval 1 minute end + to_minutes(k) as t
from (select *, unnest(range(60)) as k from ({BYTE_SAMPLES}) s) e
"""

METRIC_BYTES_GRID = f"""
select instance, t,
  round((arg_max(i, ts) - arg_min(i, ts)) / 60.0, 6) as bytes_in_per_min,
  round((arg_max(o, ts) - arg_min(o, ts)) / 60.0, 6) as bytes_out_per_min
from ({BYTE_POINTS}) g group by instance, t having count(*) >= 2
"""

# Restarting counters and gauges, with a second sample at every ninth event's time.
PANEL_ROWS = """
select event_id, ts, user_id, upper(event_type) as state, value,
  case when event_id % 9 = 0 then value else 0 end as extra
from (select event_id, ts, user_id, event_type, value from events
      union all
      select event_id, ts, user_id, event_type, value + 3 from events where event_id % 9 = 0) e
"""

PANEL_BYTES = f"""
select 'broker-' || cast(user_id % 2 as varchar) as instance, 'i' as m, ts,
  (event_id % 400) * 10 + extra as value from ({PANEL_ROWS}) p
union all
select 'broker-' || cast(user_id % 2 as varchar), 'o', ts, (event_id % 150) * 7 + extra
from ({PANEL_ROWS}) p
"""


def _grid(samples: str, points: int) -> str:
    """Every sample at each grid minute of the ``points`` windows it lies in."""
    return f"""
select *, case when ts = date_trunc('minute', ts) then ts
       else date_trunc('minute', ts) + interval 1 minute end + to_minutes(k) as t
from (select *, unnest(range({points})) as k from ({samples}) s) e
"""


BYTE_INCREASES = f"""
select *, row_number() over w as n,
  case when lag(value) over w is null then 0 when value < lag(value) over w then value
       else value - lag(value) over w end as inc
from ({PANEL_BYTES}) b window w as (partition by instance, m order by ts, value)
"""

METRIC_BYTES_RATE_GRID = f"""
with r as (
  select instance, m, t, (sum(inc) - arg_min(inc, n)) / 3600.0 as rate
  from ({_grid(BYTE_INCREASES, 60)}) g group by instance, m, t having count(*) >= 2)
select instance, t, round(sum(rate) filter (where m = 'i'), 6) as bytes_in_per_s,
  round(sum(rate) filter (where m = 'o'), 6) as bytes_out_per_s
from r group by instance, t
"""

PANEL_GAUGES = f"""
select 'node-' || cast(user_id % 2 as varchar) as instance, ts, state, event_id * 0.5 + extra as cpu,
  user_id % 50 + extra as threads, value * 1000000 as heap, user_id % 20 + extra as in_state
from ({PANEL_ROWS}) p
"""

METRIC_INSTANT_GRID = f"""
select instance, t, arg_max(cpu, (ts, cpu)) as cpu_seconds,
  arg_max(threads, (ts, threads)) as threads, arg_max(heap, (ts, heap)) as heap_bytes
from ({_grid(PANEL_GAUGES, 5)}) g group by instance, t
"""

METRIC_THREAD_STATES_GRID = f"""
select state, t, sum(v) as threads from (
  select instance, state, t, arg_max(in_state, (ts, in_state)) as v
  from ({_grid(PANEL_GAUGES, 5)}) g group by instance, state, t) x
group by state, t
"""

STAGE_LATENCY_SKETCH = f"""
with h as (
  select t_summoner as t, 'summoner->summoner_details' as hop from ({STAGE_ROWS}) s
  union all
  select t_details, 'summoner_details->match' from ({STAGE_ROWS}) s where t_match is not null)
select unit, start, hop, count(*) as n, true as whole, true as p50_close, true as p95_close
from (select 'hour' as unit, date_trunc('hour', t) as start, hop from h
      union all
      select 'day', cast(date_trunc('day', t) as timestamp), hop from h) u
group by unit, start, hop
"""
