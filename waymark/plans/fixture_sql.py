"""The fixture views of ``waymark.plans.fixtures`` as DuckDB CTE text."""

from __future__ import annotations

from waymark.plans.fixtures import INVALID_GUESS_EVERY

SIGNS = """signs AS (
  SELECT CASE WHEN l.l_orderkey % 2 = 0 THEN n.n_name || ' & ' || s.s_name
              ELSE n.n_name || ' - ' || s.s_name END AS intersection,
         p.p_name AS text_on_sign_exact,
         CASE WHEN p.p_type = 'ECONOMY' THEN 'street_sign' ELSE lower(p.p_type) END AS code_type,
         l.l_orderkey AS src_order, CAST(l.l_linenumber AS BIGINT) AS src_line, l.l_partkey AS src_part
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

COORD_LOOKUP_RAW = """coord_lookup_raw AS (
  SELECT n.n_name || ' - ' || s.s_name AS intersection,
         CAST(39 + s.s_suppkey % 2 AS VARCHAR) || '°' || CAST(s.s_suppkey * 7 % 60 AS VARCHAR) || ''''
           || CAST(CAST(((s.s_suppkey * 13 + 50 * d.dup) % 600) / 10 AS DECIMAL(5,1)) AS VARCHAR) || '"N '
           || CAST(104 + s.s_suppkey % 2 AS VARCHAR) || '°' || CAST(s.s_suppkey * 11 % 60 AS VARCHAR) || ''''
           || CAST(CAST(((s.s_suppkey * 17) % 600) / 10 AS DECIMAL(5,1)) AS VARCHAR) || '"W' AS cd,
         n.n_name AS city, CAST(80000 + s.s_suppkey AS VARCHAR) AS zip,
         s.s_suppkey * 10 + d.dup AS ord
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) d ON d.dup = 0 OR s.s_suppkey % 10 = 3
  WHERE s.s_suppkey % 10 <> 9)"""


def _truth(k: str) -> tuple[str, str]:
    return (f"CAST(39 + (({k} * 37) % 1000) / 1000 AS DOUBLE)",
            f"CAST(-105 + (({k} * 91) % 1000) / 1000 AS DOUBLE)")


def scored(with_initial: bool = False) -> str:
    lat, lon = _truth("l_suppkey")
    dlat = "(((l_orderkey * 7) % 101) - 50) / 1000"
    dlon = "(((l_orderkey * 13) % 101) - 50) / 1000"
    extra = ""
    if with_initial:
        extra = (f",\n         {lat} + 2 * {dlat} AS initial_predicted_latitude,"
                 f"\n         {lon} + 2 * {dlon} AS initial_predicted_longitude")
    return f"""scored_raw AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS intersection,
         {lat} AS latitude, {lon} AS longitude,
         {lat} + {dlat} AS predicted_latitude,
         {lon} + {dlon} AS predicted_longitude{extra}
  FROM lineitem)"""


_CLAT, _CLON = _truth("s_suppkey")

CITIES = f"""cities AS (
  SELECT 'C' || CAST(s_suppkey % (SELECT greatest(1, count(*) * 3 // 5) FROM supplier) AS VARCHAR) AS name,
         CASE WHEN s_nationkey % 3 = 0 THEN 'US' ELSE 'XX' END AS countrycode,
         {_CLAT} AS latitude, {_CLON} AS longitude,
         CAST(floor(s_acctbal / 1000) AS BIGINT) AS population,
         ['A' || CAST(s_suppkey % (SELECT greatest(1, count(*) * 2 // 5) FROM supplier) AS VARCHAR), 'C' || CAST(s_suppkey % 7 AS VARCHAR)] AS alternatenames,
         s_suppkey AS ord
  FROM supplier)"""

CITY_POINTS = f"""city_points AS (
  SELECT s_name AS name, {_CLAT} AS latitude, {_CLON} AS longitude FROM supplier)"""

CITY_PAIR_LIST = """city_pair_list AS (
  SELECT 'C' || (o_orderkey % (SELECT greatest(1, count(*) * 3 // 5) FROM supplier)) AS city_from,
         'C' || (o_custkey % ((SELECT greatest(1, count(*) * 3 // 5) FROM supplier) + 2)) AS city_to
  FROM orders)"""

ROUNDS = f"""rounds AS (
  SELECT s_suppkey AS round_id, s_name AS text, {_CLAT} AS latitude, {_CLON} AS longitude,
         {_CLAT} + (((s_suppkey * 7) % 101) - 50) / 1000 AS predicted_latitude,
         {_CLON} + (((s_suppkey * 13) % 101) - 50) / 1000 AS predicted_longitude
  FROM supplier)"""

GUESSES = f"""guesses AS (
  SELECT event_id AS guess_id, ts,
         CASE WHEN event_id % 89 = 0 THEN -1 ELSE event_id % ((SELECT count(*) FROM supplier) + 1) END AS round_id,
         CAST(CASE WHEN event_id % {INVALID_GUESS_EVERY} = 0 THEN 95.0 ELSE 39 + value / 490 END AS DOUBLE) AS latitude,
         CAST(CASE WHEN event_id % 83 = 0 THEN 185.0 ELSE -105 + (user_id % 100) / 100 END AS DOUBLE) AS longitude,
         CASE WHEN event_id % 79 = 0 THEN ' ' || chr(9) || ' ' WHEN event_id % 73 = 0 THEN NULL
              WHEN event_id % 71 = 0 THEN repeat('x', 4001) ELSE 'guess ' || event_id END AS text
  FROM events)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
