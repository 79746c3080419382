"""Road-side registered queries over derived vehicle positions and link dimension.

Stored data is replayed, so windows end at the newest stored position
(``as_of="max"``); positions are one per day, so the live windows (30 s,
5 min, 60 s) become 7 days, 90 days and 7 days.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from lakehound.operators import aggregates as A
from lakehound.functions.scalar import round_half_up
from lakehound.operators.filters import bbox_filter
from lakehound.operators.metrics import accuracy
from lakehound.plans import road_panels as R
from lakehound.plans.catalog import register
from lakehound.plans.features import congestion_features
from lakehound.plans.oracle import road, road_pred
from lakehound.sources import fixtures as X
from lakehound.sources.tables import Tables

SEEN_DAYS, ROLLING_DAYS = 7, 90
SEEN = FRESH = f"{SEEN_DAYS} DAYS"
ROLLING = f"{ROLLING_DAYS} DAYS"
AS_OF_SQL = "(SELECT max(created_at) FROM vehicle_positions)"


def _pos(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t, X.vehicle_positions(t)


def _window(spark, sf_dir, days: int):
    """The stored positions of the last ``days`` and the time they are seen from, which the manifest knows."""
    t = Tables(spark, sf_dir)
    snap = X.stored_positions(t)
    as_of = snap.as_of()
    return t, snap.read(as_of - timedelta(days=days) if as_of else None), F.lit(as_of)


@register("snapshot_positions", road("""
SELECT id, pos_uuid, vehicle_id, latitude, longitude, speed_kmh, link_id, road_type, maxspeed,
  sim_hour, sim_dow, created_at FROM vehicle_positions"""))
def snapshot_positions(spark, sf_dir):
    """The snapshot after a bulk load and two folded batches, equal to the dedup of all rows."""
    return X.stored_positions(Tables(spark, sf_dir)).read().drop("tie")


@register("latest_positions", road("""
SELECT id, pos_uuid, vehicle_id, latitude, longitude, speed_kmh, link_id, road_type, maxspeed,
  sim_hour, sim_dow, created_at FROM vehicle_positions"""))
def latest_positions(spark, sf_dir):
    _, pos = _pos(spark, sf_dir)
    return pos


@register("congestion_features", road("""
SELECT road_type, maxspeed, sim_hour, sim_dow,
  CASE WHEN speed_kmh < 12 THEN 2 WHEN speed_kmh < 24 THEN 1 ELSE 0 END AS congestion
FROM vehicle_positions"""))
def congestion_features_q(spark, sf_dir):
    _, pos = _pos(spark, sf_dir)
    return congestion_features(pos)


@register("position_count", road("SELECT count(*) AS positions FROM vehicle_positions"))
def position_count(spark, sf_dir):
    _, pos = _pos(spark, sf_dir)
    return R.position_count(pos)


@register("active_vehicles", road(f"""
SELECT count(DISTINCT vehicle_id) AS vehicles FROM vehicle_positions
WHERE created_at > {AS_OF_SQL} - INTERVAL {SEEN}"""))
def active_vehicles(spark, sf_dir):
    _, pos, as_of = _window(spark, sf_dir, SEEN_DAYS)
    return R.active_vehicles(pos, as_of, SEEN)


@register("congested_links", road(f"""
, lately AS (SELECT *, max(created_at) OVER () AS as_of FROM vehicle_positions),
links AS (SELECT link_id, sum(speed_kmh) AS speeds, count(*) AS n FROM lately WHERE created_at > as_of - INTERVAL {ROLLING} GROUP BY link_id)
SELECT count(*) FILTER (n >= 10 AND speeds < 12 * n) AS congested_links FROM links"""))
def congested_links(spark, sf_dir):
    _, pos, as_of = _window(spark, sf_dir, ROLLING_DAYS)
    return R.congested_links(pos, as_of, ROLLING, 10)


_LINK_CONGESTION_SQL = f"""
  SELECT link_id, CASE WHEN avg(speed_kmh) < 12 THEN 2 WHEN avg(speed_kmh) < 24 THEN 1 ELSE 0 END AS congestion,
    count(*) AS n, CAST(round(CAST(avg(speed_kmh) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_speed, max(created_at) AS last_seen
  FROM vehicle_positions WHERE created_at > {AS_OF_SQL} - INTERVAL {ROLLING}
  GROUP BY link_id
  HAVING count(*) >= 10 AND max(created_at) > {AS_OF_SQL} - INTERVAL {FRESH}"""


@register("link_congestion", road(_LINK_CONGESTION_SQL))
def link_congestion(spark, sf_dir):
    _, pos, as_of = _window(spark, sf_dir, ROLLING_DAYS)
    return R.link_congestion(pos, as_of, ROLLING, FRESH, 10)


_MAP_SQL = f""",
stats AS ({_LINK_CONGESTION_SQL}),
places AS (SELECT link_id, mid_lat AS latitude, mid_lon AS longitude, bearing FROM link_geo)
"""


@register("congestion_map", road(_MAP_SQL + """
SELECT latitude, longitude, bearing, congestion, n, avg_speed, link_id FROM stats NATURAL JOIN places"""))
def congestion_map(spark, sf_dir):
    t, pos, as_of = _window(spark, sf_dir, ROLLING_DAYS)
    return R.congestion_map(pos, X.link_geo(t), as_of, ROLLING, FRESH, 10)


@register("congestion_map_all_links", road(_MAP_SQL + """
SELECT latitude, longitude, bearing, congestion, n, avg_speed, link_id FROM places NATURAL LEFT JOIN stats"""))
def congestion_map_all_links(spark, sf_dir):
    t, pos, as_of = _window(spark, sf_dir, ROLLING_DAYS)
    return R.congestion_map(pos, X.link_geo(t), as_of, ROLLING, FRESH, 10, all_links=True)


@register("last_position", road(f"""
SELECT vehicle_id, latitude, longitude, speed_kmh, link_id FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY created_at DESC, latitude DESC,
    longitude DESC, speed_kmh DESC, link_id DESC) AS rn
  FROM vehicle_positions WHERE created_at > {AS_OF_SQL} - INTERVAL {SEEN}) x
WHERE rn = 1"""))
def last_position(spark, sf_dir):
    _, pos, as_of = _window(spark, sf_dir, SEEN_DAYS)
    return R.last_position(pos, as_of, SEEN)


_BOX = {"some": (34.95, 136.2, 34.92, 135.9), "none": (0.0, 0.0, 1.0, 1.0)}


def _box_sql(box) -> str:
    (a, b), (c, d) = sorted(box[0::2]), sorted(box[1::2])
    inside = f"latitude BETWEEN {a} AND {b} AND longitude BETWEEN {c} AND {d}"
    return f"SELECT pos_uuid FROM vehicle_positions WHERE ({inside}) OR NOT EXISTS (SELECT 1 FROM vehicle_positions WHERE {inside})"


@register("positions_in_box", road(_box_sql(_BOX["some"])))
def positions_in_box(spark, sf_dir):
    """Positions inside a box, its corners in any order."""
    return bbox_filter(_pos(spark, sf_dir)[1], _BOX["some"], "latitude", "longitude").select("pos_uuid")


@register("positions_box_fallback", road(_box_sql(_BOX["none"])))
def positions_box_fallback(spark, sf_dir):
    """A box without positions gives all of them."""
    return bbox_filter(_pos(spark, sf_dir)[1], _BOX["none"], "latitude", "longitude").select("pos_uuid")


@register("speed_by_road_type", road("""
SELECT date_trunc('minute', created_at) AS time, road_type, avg(speed_kmh) AS avg_speed
FROM vehicle_positions GROUP BY 1, 2 ORDER BY time, road_type"""))
def speed_by_road_type(spark, sf_dir):
    _, pos = _pos(spark, sf_dir)
    return R.speed_by_road_type(pos)


@register("mean_congestion", road_pred("""
SELECT date_trunc('minute', event_time) AS time, avg(pred_congestion) AS avg_congestion
FROM congestion_pred GROUP BY 1 ORDER BY time"""))
def mean_congestion(spark, sf_dir):
    t, pos = _pos(spark, sf_dir)
    return R.mean_congestion(X.congestion_pred(t, pos))


@register("pred_vs_actual", road_pred("""
SELECT road_type, count(*) AS n, CAST(round(CAST(avg(pred_congestion) AS DECIMAL(38,10)), 2) AS DOUBLE) AS pred_avg,
  CAST(round(CAST(avg(actual_congestion) AS DECIMAL(38,10)), 2) AS DOUBLE) AS actual_avg
FROM congestion_pred GROUP BY road_type ORDER BY n DESC, road_type"""))
def pred_vs_actual(spark, sf_dir):
    t, pos = _pos(spark, sf_dir)
    return R.pred_vs_actual(X.congestion_pred(t, pos))


@register("recent_congestion", road_pred("""
SELECT event_time, vehicle_id, road_type, link_id, sim_hour, pred_congestion, actual_congestion,
  CAST(round(CAST(pred_proba AS DECIMAL(38,10)), 3) AS DOUBLE) AS prob
FROM congestion_pred ORDER BY scored_at DESC, pos_uuid LIMIT 100"""))
def recent_congestion(spark, sf_dir):
    # predictions are made in order of event time, so the newest ranges of positions hold them
    t = Tables(spark, sf_dir)
    return R.recent_congestion(X.congestion_pred(t, X.stored_positions(t).newest(100)), 100)


@register("congestion_confusion", road_pred("""
SELECT pred_congestion AS predicted, actual_congestion AS actual, count(*) AS n
FROM congestion_pred GROUP BY 1, 2 ORDER BY 1, 2"""))
def congestion_confusion(spark, sf_dir):
    t, pos = _pos(spark, sf_dir)
    return A.confusion(X.congestion_pred(t, pos), "pred_congestion", "actual_congestion")


@register("congestion_accuracy", road_pred("""
SELECT CAST(round(CAST(avg(CASE WHEN pred_congestion = actual_congestion THEN 1.0 ELSE 0.0 END) AS DECIMAL(38,10)), 6) AS DOUBLE) AS accuracy FROM congestion_pred"""))
def congestion_accuracy(spark, sf_dir):
    """M7: share of stored predictions that equal the level seen."""
    t, pos = _pos(spark, sf_dir)
    return accuracy(X.congestion_pred(t, pos), "pred_congestion", "actual_congestion").select(round_half_up("accuracy", 6).alias("accuracy"))
