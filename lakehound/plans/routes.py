"""A road graph derived from the stored positions.

Nodes are the links' fixed midpoints (``link_geo``). Each pair of consecutive
stops of one order, (order, line k) -> (order, line k + 1), is an edge from
the first stop's link to the second's, drawn as a four-vertex polyline:
start node, first stop, second stop, end node. The pairing is an equi join
on the unique (order, line) key, so a very long order does not gather into
one task. Everything after that is per-row geometry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions import geo
from lakehound.session import saved


def stops(pos: DataFrame) -> DataFrame:
    """Positions with (order, line) split out of ``pos_uuid``."""
    parts = F.split("pos_uuid", "-")
    return pos.select(parts[0].cast("long").alias("o"), parts[1].cast("int").alias("k"),
                      "pos_uuid", "link_id", "road_type", "maxspeed", "speed_kmh",
                      "latitude", "longitude")


def route_nodes(link_geo: DataFrame) -> DataFrame:
    return link_geo.select(F.col("link_id").alias("node_id"), F.col("mid_lat").alias("lat"),
                           F.col("mid_lon").alias("lon"))


def route_edges(pos: DataFrame, link_geo: DataFrame) -> DataFrame:
    """Edges (src, dst, edge_key, link_id, road_type, maxspeed, speed_kmh, poly)."""
    # both sides of the join read the positions, which are mostly the outcome of a dedup: it is run once
    a = stops(saved(pos.select("pos_uuid", "link_id", "road_type", "maxspeed", "speed_kmh", "latitude", "longitude"), "stops"))
    b = a.select("o", (F.col("k") - 1).alias("k"), F.col("link_id").alias("dst"),
                 F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"))
    hops = a.join(b, ["o", "k"]).withColumnRenamed("link_id", "src")
    nodes = route_nodes(link_geo)
    s = nodes.select(F.col("node_id").alias("src"), F.col("lat").alias("slat"),
                     F.col("lon").alias("slon"))
    d = nodes.select(F.col("node_id").alias("dst"), F.col("lat").alias("dlat"),
                     F.col("lon").alias("dlon"))
    j = hops.join(s, "src").join(d, "dst")
    poly = F.array(geo.point("slat", "slon"), geo.point("latitude", "longitude"),
                   geo.point("lat2", "lon2"), geo.point("dlat", "dlon"))
    return j.select("src", "dst", F.col("pos_uuid").alias("edge_key"),
                    F.concat_ws("_", "src", "dst", "pos_uuid").alias("link_id"),
                    "road_type", "maxspeed", "speed_kmh", poly.alias("poly"))
