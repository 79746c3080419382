"""Registered road-graph queries over the route graph derived from positions.

Output coordinates are rounded to 7 decimals (about 1 cm), bearings to 4 and
lengths to the millimetre: the JVM and DuckDB trigonometric functions differ
in the last bit, which these precisions hide.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lakehound.functions import geo
from lakehound.operators import roadgraph as G
from lakehound.plans.catalog import register
from lakehound.plans.oracle import road
from lakehound.plans.routes import route_edges, route_nodes
from lakehound.session import shared_dir
from lakehound.sources import fixtures as X
from lakehound.sources.sinks import export_geojson
from lakehound.sources.tables import Tables


def _hav(a_lat, a_lon, b_lat, b_lon) -> str:
    return (f"12742000.0 * asin(sqrt(pow(sin(radians({b_lat} - {a_lat}) / 2), 2) + "
            f"cos(radians({a_lat})) * cos(radians({b_lat})) * pow(sin(radians({b_lon} - {a_lon}) / 2), 2)))")


def _bearing(a_lat, a_lon, b_lat, b_lon) -> str:
    y = f"sin(radians({b_lon} - {a_lon})) * cos(radians({b_lat}))"
    x = (f"cos(radians({a_lat})) * sin(radians({b_lat})) - sin(radians({a_lat})) * cos(radians({b_lat}))"
         f" * cos(radians({b_lon} - {a_lon}))")
    return f"((degrees(atan2({y}, {x})) + 360.0) % 360.0)"


EDGES_SQL = """,
stops AS (
  SELECT CAST(split_part(pos_uuid, '-', 1) AS BIGINT) AS o, CAST(split_part(pos_uuid, '-', 2) AS INTEGER) AS k,
    pos_uuid, link_id, road_type, maxspeed, speed_kmh, latitude, longitude FROM vehicle_positions
),
edges AS (
  SELECT a.link_id AS src, b.link_id AS dst, a.pos_uuid AS edge_key,
    a.link_id || '_' || b.link_id || '_' || a.pos_uuid AS link_id, a.road_type, a.maxspeed, a.speed_kmh,
    gs.mid_lat AS lat0, gs.mid_lon AS lon0, a.latitude AS lat1, a.longitude AS lon1,
    b.latitude AS lat2, b.longitude AS lon2, gd.mid_lat AS lat3, gd.mid_lon AS lon3
  FROM stops a JOIN stops b ON a.o = b.o AND b.k = a.k + 1
  JOIN link_geo gs ON gs.link_id = a.link_id JOIN link_geo gd ON gd.link_id = b.link_id
),
segs AS (
  SELECT *, """ + _hav("lat0", "lon0", "lat1", "lon1") + """ AS s1,
    """ + _hav("lat1", "lon1", "lat2", "lon2") + """ AS s2,
    """ + _hav("lat2", "lon2", "lat3", "lon3") + """ AS s3 FROM edges
)
"""


def _edges(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lg = X.link_geo(t)
    return t, lg, route_edges(X.vehicle_positions(t), lg)


@register("route_edges", road(EDGES_SQL + """
SELECT link_id, src, dst, 4 AS n_points, round(s1 + s2 + s3, 3) AS length_m FROM segs"""))
def q_route_edges(spark, sf_dir):
    _, _, e = _edges(spark, sf_dir)
    return e.select("link_id", "src", "dst", F.size("poly").alias("n_points"),
                    F.round(geo.polyline_length("poly"), 3).alias("length_m"))


_MID_SQL = EDGES_SQL + """,
pick AS (
  SELECT *, (s1 + s2 + s3) / 2 AS half,
    CASE WHEN s1 >= (s1 + s2 + s3) / 2 THEN 1 WHEN s1 + s2 >= (s1 + s2 + s3) / 2 THEN 2 ELSE 3 END AS seg
  FROM segs
),
ends AS (
  SELECT link_id,
    CASE seg WHEN 1 THEN lat0 WHEN 2 THEN lat1 ELSE lat2 END AS alat,
    CASE seg WHEN 1 THEN lon0 WHEN 2 THEN lon1 ELSE lon2 END AS alon,
    CASE seg WHEN 1 THEN lat1 WHEN 2 THEN lat2 ELSE lat3 END AS blat,
    CASE seg WHEN 1 THEN lon1 WHEN 2 THEN lon2 ELSE lon3 END AS blon,
    CASE seg WHEN 1 THEN 0.0 WHEN 2 THEN s1 ELSE s1 + s2 END AS start,
    CASE seg WHEN 1 THEN s1 WHEN 2 THEN s2 ELSE s3 END AS len, half
  FROM pick
),
frac AS (
  SELECT *, CASE WHEN len > 0 THEN least(greatest((half - start) / len, 0.0), 1.0) ELSE 0.0 END AS f FROM ends
)
"""


@register("route_link_geo", road(_MID_SQL + """
SELECT link_id, round(alat + (blat - alat) * f, 7) AS mid_lat, round(alon + (blon - alon) * f, 7) AS mid_lon,
  round(""" + _bearing("alat", "alon", "blat", "blon") + """, 4) AS bearing
FROM frac"""))
def q_route_link_geo(spark, sf_dir):
    _, _, e = _edges(spark, sf_dir)
    lg = G.link_geo(e)
    return lg.select("link_id", F.round("mid_lat", 7).alias("mid_lat"),
                     F.round("mid_lon", 7).alias("mid_lon"), F.round("bearing", 4).alias("bearing"))


@register("route_graph_stats", road(EDGES_SQL + """
SELECT (SELECT count(*) FROM link_geo) AS nodes, (SELECT count(*) FROM segs) AS edges,
  round((SELECT sum(s1 + s2 + s3) FROM segs) / 1000.0, 3) AS total_km"""))
def q_route_graph_stats(spark, sf_dir):
    _, lg, e = _edges(spark, sf_dir)
    st = G.graph_stats(route_nodes(lg), e)
    return st.select("nodes", "edges", F.round("total_km", 3).alias("total_km"))


@register("route_adjacency", road(EDGES_SQL + """
SELECT src, count(*) AS out_degree, count(DISTINCT dst) AS n_targets FROM edges GROUP BY src"""))
def q_route_adjacency(spark, sf_dir):
    _, _, e = _edges(spark, sf_dir)
    return G.adjacency(e)


#: Out-edges in one list of the registered query: small enough that many nodes need several.
LIST_EDGES = 16


@register("graph_adjacency", road(EDGES_SQL + f""",
placed AS (SELECT src, dst, link_id, row_number() OVER (PARTITION BY src ORDER BY link_id, dst) - 1 AS place FROM edges)
SELECT g.link_id AS node_id, coalesce(p.place // {LIST_EDGES}, 0) AS chunk, count(p.link_id) AS n_edges,
  coalesce(string_agg(p.dst || ':' || p.link_id, ',' ORDER BY p.place), '') AS targets
FROM link_geo g LEFT JOIN placed p ON p.src = g.link_id GROUP BY 1, 2"""))
def q_graph_adjacency(spark, sf_dir):
    """Adjacency lists of all nodes, hubs over several rows."""
    _, lg, e = _edges(spark, sf_dir)
    lists = G.adjacency_lists(route_nodes(lg), e.select("src", "dst", "link_id"), LIST_EDGES)
    written = F.array_join(F.transform("targets", lambda t: F.concat_ws(":", t["dst"], t["link_id"])), ",")
    return lists.select("node_id", "chunk", F.col("n_edges").cast("long").alias("n_edges"), written.alias("targets"))


@register("route_cumulative", road(EDGES_SQL + """
SELECT link_id, v.k AS vertex, round(CASE v.k WHEN 0 THEN 0.0 WHEN 1 THEN s1 WHEN 2 THEN s1 + s2 ELSE s1 + s2 + s3 END, 3) AS distance_m
FROM segs, range(0, 4) v(k)"""))
def q_route_cumulative(spark, sf_dir):
    """Running distance at every vertex of every edge."""
    _, _, e = _edges(spark, sf_dir)
    return geo.cumulative_distance(e, "link_id", "poly").select("link_id", "vertex", F.round("distance_m", 3).alias("distance_m"))


@register("route_point_after_minute", road(EDGES_SQL + """,
walk AS (
  SELECT link_id, speed_kmh * 1000.0 / 60.0 AS d, * EXCLUDE (link_id) FROM segs
),
seg AS (
  SELECT link_id, d,
    CASE WHEN d <= s1 THEN 1 WHEN d <= s1 + s2 THEN 2 ELSE 3 END AS k, * EXCLUDE (link_id, d) FROM walk
),
ends AS (
  SELECT link_id, d,
    CASE k WHEN 1 THEN lat0 WHEN 2 THEN lat1 ELSE lat2 END AS alat,
    CASE k WHEN 1 THEN lon0 WHEN 2 THEN lon1 ELSE lon2 END AS alon,
    CASE k WHEN 1 THEN lat1 WHEN 2 THEN lat2 ELSE lat3 END AS blat,
    CASE k WHEN 1 THEN lon1 WHEN 2 THEN lon2 ELSE lon3 END AS blon,
    CASE k WHEN 1 THEN 0.0 WHEN 2 THEN s1 ELSE s1 + s2 END AS start,
    CASE k WHEN 1 THEN s1 WHEN 2 THEN s2 ELSE s3 END AS len, lat0, lon0
  FROM seg
)
SELECT link_id,
  round(CASE WHEN d <= 0 THEN lat0 ELSE alat + (blat - alat) * (CASE WHEN len > 0 THEN (d - start) / len ELSE 0.0 END) END, 7) AS lat,
  round(CASE WHEN d <= 0 THEN lon0 ELSE alon + (blon - alon) * (CASE WHEN len > 0 THEN (d - start) / len ELSE 0.0 END) END, 7) AS lon
FROM ends"""))
def q_route_point_after_minute(spark, sf_dir):
    _, _, e = _edges(spark, sf_dir)
    e = geo.with_point_at(e, "poly", F.col("speed_kmh") * 1000.0 / 60.0, "_p")
    return e.select("link_id", F.round(F.col("_p.lat"), 7).alias("lat"),
                    F.round(F.col("_p.lon"), 7).alias("lon"))


@register("geojson_edges", road(EDGES_SQL + """
SELECT link_id, road_type, 4 AS n_points, round(lon0, 7) AS first_lon, round(lat3, 7) AS last_lat FROM segs"""))
def q_geojson_edges(spark, sf_dir):
    """Edges exported as GeoJSON lines and read back."""
    _, _, e = _edges(spark, sf_dir)
    path = os.path.join(shared_dir(spark, "geojson"), "edges")
    export_geojson(e, path)
    line = "struct<type: string, coordinates: array<array<double>>>"
    feature = F.from_json("value", f"struct<type: string, properties: struct<link_id: string, road_type: string>, geometry: {line}>")
    f = spark.read.text(path).select(feature.alias("f")).filter("f.type = 'Feature' and f.geometry.type = 'LineString'")
    at = F.col("f.geometry.coordinates")
    return f.select("f.properties.link_id", "f.properties.road_type", F.size(at).alias("n_points"),
                    F.round(F.element_at(at, 1)[0], 7).alias("first_lon"), F.round(F.element_at(at, -1)[1], 7).alias("last_lat"))
