"""DuckDB reference SQL for the registered queries.

Each string runs on the driver's base tables (registered as views) and
rebuilds the derived warehouse tables as CTEs with the same rules as
:mod:`lakehound.sources.fixtures`. Column names equal the Spark output.
"""

from __future__ import annotations

TRANSACTIONS = """
transactions AS (
  SELECT e.event_id AS id, CAST(e.event_id AS VARCHAR) AS tx_uuid, e.user_id, e.value AS amount,
    e.event_type AS merchant_category, n.n_name AS country,
    CASE e.event_id % 4 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web' ELSE 'pos' END AS device,
    CAST((n.n_nationkey * 7) % 120 - 60 AS DOUBLE) AS latitude,
    CAST((n.n_nationkey * 14) % 300 - 150 AS DOUBLE) AS longitude,
    CASE e.user_id % 4 WHEN 0 THEN 'client-jp' WHEN 1 THEN 'client-eu' WHEN 2 THEN 'client-us' ELSE 'client-fraud' END AS source,
    CASE WHEN (e.event_id * 7919) % 100 < 5 + (CASE WHEN e.value > 80 THEN 40 ELSE 0 END)
      + (CASE WHEN n.n_nationkey % 8 = 0 THEN 20 ELSE 0 END) + (CASE WHEN e.event_id % 4 = 2 THEN 15 ELSE 0 END)
      THEN 1 ELSE 0 END AS is_fraud,
    e.ts AS created_at
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

PREDICTIONS = """
predictions AS (
  SELECT tx_uuid, CAST(p AS DOUBLE) / 100 AS fraud_probability, CASE WHEN p >= 50 THEN 1 ELSE 0 END AS pred_label,
    'v1' AS model_version, created_at + INTERVAL '1' SECOND AS scored_at
  FROM (SELECT tx_uuid, id, created_at, 5 + (CASE WHEN amount > 80 THEN 45 ELSE 0 END)
    + (CASE WHEN device = 'web' THEN 15 ELSE 0 END) + id % 30 AS p FROM transactions) t
  WHERE id % 10 <> 0
)"""

POSITIONS = """
positions_raw AS (
  SELECT l.l_partkey AS id, CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS pos_uuid,
    CAST(l.l_partkey AS VARCHAR) AS vehicle_id,
    34.9 + CAST(l.l_suppkey AS DOUBLE) / 1000 + CAST(l.l_linenumber AS DOUBLE) / 10000 AS latitude,
    135.8 + CAST(l.l_partkey % 1000 AS DOUBLE) / 1000 AS longitude,
    l.l_quantity AS speed_kmh, CAST(l.l_suppkey AS VARCHAR) AS link_id, p.p_brand AS road_type,
    CAST(30 + (p.p_size % 5) * 10 AS DOUBLE) AS maxspeed, CAST(l.l_orderkey % 24 AS INTEGER) AS sim_hour,
    CAST(l.l_orderkey % 7 + 1 AS INTEGER) AS sim_dow, l.l_extendedprice AS tie, l.l_shipdate AS created_at
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
vehicle_positions AS (
  SELECT * EXCLUDE (rn, tie) FROM (
    SELECT *, row_number() OVER (PARTITION BY pos_uuid ORDER BY id DESC, tie DESC, speed_kmh DESC,
      vehicle_id, link_id, created_at DESC) AS rn FROM positions_raw) x
  WHERE rn = 1
)"""

LINK_GEO = """
link_geo AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS link_id, 34.9 + CAST(s_suppkey AS DOUBLE) / 1000 AS mid_lat,
    135.8 + CAST(s_suppkey AS DOUBLE) / 1000 AS mid_lon, CAST((s_suppkey * 37) % 360 AS DOUBLE) AS bearing
  FROM supplier
)"""

CONGESTION_PRED = """
congestion_pred AS (
  SELECT pos_uuid, vehicle_id, latitude, longitude, link_id, road_type, sim_hour,
    (lvl + CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END) % 3 AS pred_congestion,
    CAST(id % 50 + 50 AS DOUBLE) / 100 AS pred_proba, lvl AS actual_congestion, 'v1' AS model_version,
    created_at AS event_time, created_at + INTERVAL '1' SECOND AS scored_at
  FROM (SELECT *, CASE WHEN speed_kmh < 12 THEN 2 WHEN speed_kmh < 24 THEN 1 ELSE 0 END AS lvl
        FROM vehicle_positions) v
)"""

FRAUD = "WITH " + ",".join([TRANSACTIONS, PREDICTIONS]) + "\n"
ROAD = "WITH " + ",".join([POSITIONS, LINK_GEO]) + "\n"
ROAD_PRED = "WITH " + ",".join([POSITIONS, LINK_GEO, CONGESTION_PRED]) + "\n"
ALL = "WITH " + ",".join([TRANSACTIONS, PREDICTIONS, POSITIONS, LINK_GEO, CONGESTION_PRED]) + "\n"


def fraud(body: str) -> str:
    return FRAUD + body


def road(body: str) -> str:
    return ROAD + body


def road_pred(body: str) -> str:
    return ROAD_PRED + body
