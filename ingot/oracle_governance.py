"""DuckDB oracle SQL for the governance queries, against ``customer``."""

from __future__ import annotations

GENERALIZE = """
select c_custkey, c_nationkey, c_mktsegment,
  cast(floor(c_acctbal / 1000) as bigint) * 1000 as c_acctbal_band
from customer
"""

SUPPRESS = """
select c_custkey, cast(null as varchar) as c_name, c_nationkey,
  case when c_acctbal < 0 then null else c_acctbal end as c_acctbal, c_mktsegment
from customer
"""

K_ANONYMITY = """
select c_custkey, c_nationkey, c_mktsegment from customer
where (c_nationkey, c_mktsegment) in (
  select (c_nationkey, c_mktsegment) from customer
  group by c_nationkey, c_mktsegment having count(*) >= 10)
"""

TOKENIZE = """
select c_custkey, sha256('ingot-salt-v1' || c_name) as c_name_token from customer
"""

TOKEN_VAULT = """
select c_custkey, c_name, true as renewed,
  (select count(distinct c_name) from customer) as vault_size
from customer
"""

K_ANONYMITY_CLASSES = """
select c_custkey, c_acctbal as own_c_acctbal, c_nationkey as own_c_nationkey, true as large,
  true as inside, true as several
from customer
"""
