"""Registered queries over a GraphML road graph: written from the stored routes, read back as a map file.

The file has what map files have: nodes without a place, edges to nodes that are not there, edges
without a key (so that link ids collide), list-valued road types, speeds in mph or none, geometries
missing or too short.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lakehound.functions import geo
from lakehound.operators import roadgraph as G
from lakehound.plans.catalog import register
from lakehound.plans.oracle import road
from lakehound.plans.queries_routes import EDGES_SQL, _bearing, _hav
from lakehound.plans.routes import route_edges, route_nodes
from lakehound.session import shared_dir
from lakehound.sources import fixtures as X
from lakehound.sources.graphml import read_graphml, write_graphml
from lakehound.sources.tables import Tables

GRAPH_SQL = EDGES_SQL + f""",
g_nodes AS (SELECT link_id AS node_id, mid_lat AS lat, mid_lon AS lon FROM link_geo WHERE CAST(link_id AS BIGINT) % 13 <> 0),
numbered AS (SELECT *, CAST(split_part(edge_key, '-', 1) AS BIGINT) AS o, CAST(split_part(edge_key, '-', 2) AS INTEGER) AS k FROM segs),
g AS (
  SELECT src, dst, CASE WHEN o % 5 <> 0 THEN edge_key END AS edge_key,
    src || '_' || dst || CASE WHEN o % 5 <> 0 THEN '_' || edge_key ELSE '' END AS link_id,
    CASE k % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'unknown' ELSE 'motorway_link' END AS road_type,
    CASE o % 3 WHEN 0 THEN 25::DOUBLE * 1.60934::DOUBLE WHEN 1 THEN 50.0 ELSE CASE k % 4 WHEN 0 THEN 60.0 WHEN 1 THEN 50.0 WHEN 2 THEN 40.0 ELSE 60.0 END END AS maxspeed,
    o % 7 IN (1, 2) AS straight, lat0, lon0, lat1, lon1, lat2, lon2, lat3, lon3, s1, s2, s3,
    {_hav("lat0", "lon0", "lat3", "lon3")} AS s0
  FROM numbered WHERE o % 11 <> 3 AND src IN (SELECT node_id FROM g_nodes) AND dst IN (SELECT node_id FROM g_nodes)
)
"""


def graph_file(spark, sf_dir, directed: bool = True) -> str:
    """The road graph of the stored routes as a folder of GraphML."""
    t = Tables(spark, sf_dir)
    links = X.link_geo(t)
    nodes = route_nodes(links).withColumn("lon", F.when(F.col("node_id").cast("long") % 13 != 0, F.col("lon")))
    at = F.split("edge_key", "-")
    o, k = at[0].cast("long"), at[1].cast("int")
    line = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform("poly", lambda p: F.concat_ws(" ", p["lon"], p["lat"])), ", "), F.lit(")"))
    edges = route_edges(X.vehicle_positions(t), links).select(
        "src", F.when(o % 11 == 3, F.concat(F.lit("lost"), "dst")).otherwise(F.col("dst")).alias("dst"),
        F.when(o % 5 != 0, F.col("edge_key")).alias("edge_key"),
        F.when(o % 7 == 2, "LINESTRING (1 2)").when(o % 7 != 1, line).alias("geometry"),
        F.when(k % 4 == 0, "primary").when(k % 4 == 1, "['secondary', 'tertiary']").when(k % 4 == 3, "motorway_link").alias("highway"),
        F.when(o % 3 == 0, "25 mph").when(o % 3 == 1, "50").alias("maxspeed_raw"))
    folder = os.path.join(shared_dir(spark, "graphml"), "road")
    write_graphml(nodes, edges, folder, directed)
    return folder


def _graph(spark, sf_dir, directed: bool = True):
    return read_graphml(spark, graph_file(spark, sf_dir, directed))


@register("graphml_nodes", road(GRAPH_SQL + "SELECT node_id, round(lat, 7) AS lat, round(lon, 7) AS lon FROM g_nodes"))
def graphml_nodes(spark, sf_dir):
    """Nodes with both coordinates."""
    nodes, _ = _graph(spark, sf_dir)
    return nodes.select("node_id", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"))


@register("graphml_edges", road(GRAPH_SQL + """
SELECT src, dst, edge_key, link_id, road_type, maxspeed, CASE WHEN straight THEN 2 ELSE 4 END AS n_points,
  round(CASE WHEN straight THEN s0 ELSE s1 + s2 + s3 END, 3) AS length_m FROM g"""))
def graphml_edges(spark, sf_dir):
    """Edges between known nodes with geometry and attributes."""
    _, edges = _graph(spark, sf_dir)
    return edges.select("src", "dst", "edge_key", "link_id", "road_type", "maxspeed", F.size("poly").alias("n_points"),
                        F.round(geo.polyline_length("poly"), 3).alias("length_m"))


@register("graphml_road_types", road(GRAPH_SQL + """
SELECT road_type, count(*) AS edges, CASE road_type WHEN 'primary' THEN 60.0 WHEN 'secondary' THEN 50.0 WHEN 'motorway_link' THEN 60.0 ELSE 40.0 END::DOUBLE AS default_maxspeed,
  count(*) FILTER (maxspeed > CASE road_type WHEN 'primary' THEN 60.0 WHEN 'secondary' THEN 50.0 WHEN 'motorway_link' THEN 60.0 ELSE 40.0 END) AS above
FROM g GROUP BY road_type"""))
def graphml_road_types(spark, sf_dir):
    """Edges beside the constants of their road type."""
    _, edges = _graph(spark, sf_dir)
    typed = G.with_road_type_constants(edges.select("road_type", "maxspeed"), spark)
    return typed.groupBy("road_type", "default_maxspeed").agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("maxspeed") > F.col("default_maxspeed")).alias("above"))


_PICK_SQL = GRAPH_SQL + """,
firsts AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY src, dst, edge_key,
    CASE WHEN straight THEN lat3 ELSE lat1 END, CASE WHEN straight THEN lon3 ELSE lon1 END,
    CASE WHEN NOT straight THEN lat2 END NULLS FIRST, CASE WHEN NOT straight THEN lon2 END NULLS FIRST) AS rn FROM g) x WHERE rn = 1),
halves AS (SELECT *, (s1 + s2 + s3) / 2 AS half FROM firsts),
ends AS (
  SELECT link_id,
    CASE WHEN straight OR s1 >= half THEN lat0 WHEN s1 + s2 >= half THEN lat1 ELSE lat2 END AS alat,
    CASE WHEN straight OR s1 >= half THEN lon0 WHEN s1 + s2 >= half THEN lon1 ELSE lon2 END AS alon,
    CASE WHEN straight THEN lat3 WHEN s1 >= half THEN lat1 WHEN s1 + s2 >= half THEN lat2 ELSE lat3 END AS blat,
    CASE WHEN straight THEN lon3 WHEN s1 >= half THEN lon1 WHEN s1 + s2 >= half THEN lon2 ELSE lon3 END AS blon,
    CASE WHEN straight THEN CASE WHEN s0 > 0 THEN 0.5 ELSE 0.0 END
      WHEN s1 >= half THEN CASE WHEN s1 > 0 THEN half / s1 ELSE 0.0 END
      WHEN s1 + s2 >= half THEN CASE WHEN s2 > 0 THEN (half - s1) / s2 ELSE 0.0 END
      ELSE CASE WHEN s3 > 0 THEN (half - s1 - s2) / s3 ELSE 0.0 END END AS f
  FROM halves)
"""


@register("graphml_link_geo", road(_PICK_SQL + """
SELECT link_id, round(alat + (blat - alat) * least(greatest(f, 0.0), 1.0), 7) AS mid_lat,
  round(alon + (blon - alon) * least(greatest(f, 0.0), 1.0), 7) AS mid_lon,
  round(""" + _bearing("alat", "alon", "blat", "blon") + """, 4) AS bearing FROM ends"""))
def graphml_link_geo(spark, sf_dir):
    """One midpoint per link id, where ids collide."""
    _, edges = _graph(spark, sf_dir)
    lg = G.link_geo(edges)
    return lg.select("link_id", F.round("mid_lat", 7).alias("mid_lat"), F.round("mid_lon", 7).alias("mid_lon"), F.round("bearing", 4).alias("bearing"))


@register("graphml_reverse", road(GRAPH_SQL + """
SELECT src, dst, link_id, false AS is_reverse, round(lat0, 7) AS first_lat, round(lon3, 7) AS last_lon FROM g
UNION ALL SELECT dst, src, link_id, true, round(lat3, 7), round(lon0, 7) FROM g"""))
def graphml_reverse(spark, sf_dir):
    """An undirected file gives every edge both ways."""
    _, edges = _graph(spark, sf_dir, directed=False)
    return edges.select("src", "dst", "link_id", "is_reverse", F.round(F.element_at("poly", 1)["lat"], 7).alias("first_lat"),
                        F.round(F.element_at("poly", -1)["lon"], 7).alias("last_lon"))


@register("graphml_adjacency", road(GRAPH_SQL + """,
placed AS (SELECT src, link_id, dst, row_number() OVER (PARTITION BY src ORDER BY link_id, dst) - 1 AS place FROM (
  SELECT src, dst, link_id FROM g UNION ALL SELECT dst, src, link_id FROM g) b)
SELECT n.node_id, coalesce(p.place // 64, 0) AS chunk, count(p.link_id) AS n_edges,
  coalesce(string_agg(p.dst || ':' || p.link_id, ',' ORDER BY p.place), '') AS targets
FROM g_nodes n LEFT JOIN placed p ON p.src = n.node_id GROUP BY 1, 2"""))
def graphml_adjacency(spark, sf_dir):
    """Adjacency lists of the undirected file's nodes, 64 edges a list."""
    nodes, edges = _graph(spark, sf_dir, directed=False)
    written = F.array_join(F.transform("targets", lambda t: F.concat_ws(":", t["dst"], t["link_id"])), ",")
    return G.adjacency_lists(nodes, edges.select("src", "dst", "link_id", "is_reverse"), 64).select("node_id", "chunk", F.col("n_edges").cast("long").alias("n_edges"), written.alias("targets"))
