"""Road-graph operators.

Graph frames: ``nodes(node_id, lat, lon)`` and ``edges(src, dst, edge_key,
link_id, road_type, maxspeed, poly)``. Every edge carries its own polyline,
so geometry is computed row by row; joins only attach node coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehound.functions import geo
from lakehound.functions.scalar import link_id as make_link_id, parse_highway, parse_maxspeed
from lakehound.operators.dedup import first_by_key
from lakehound.operators.ranks import with_place

# Per road type the default max speed (km/h) when the edge has none.
ROAD_TYPES = [
    ("motorway", 100.0),
    ("motorway_link", 60.0),
    ("trunk", 60.0),
    ("trunk_link", 50.0),
    ("primary", 60.0),
    ("primary_link", 50.0),
    ("secondary", 50.0),
    ("secondary_link", 40.0),
    ("tertiary", 40.0),
    ("tertiary_link", 40.0),
    ("residential", 40.0),
    ("unclassified", 40.0),
    ("service", 30.0),
]
DEFAULT_MAXSPEED = 40.0


def _lookup(rt: Column, idx: int, default: float) -> Column:
    m = F.create_map(*[x for row in ROAD_TYPES for x in (F.lit(row[0]), F.lit(row[idx]))])
    return F.coalesce(F.try_element_at(m, rt), F.lit(default))


def default_maxspeed(road_type) -> Column:
    """Type default speed, else 40 km/h (literal map lookup, no join)."""
    rt = F.col(road_type) if isinstance(road_type, str) else road_type
    return _lookup(rt, 1, DEFAULT_MAXSPEED)


def road_type_dim(spark: SparkSession) -> DataFrame:
    """The road-type constants as a 13-row dimension table."""
    return spark.createDataFrame(ROAD_TYPES, "road_type string, default_maxspeed double")


def with_road_type_constants(df: DataFrame, spark: SparkSession,
                             road_type: str = "road_type") -> DataFrame:
    """Broadcast left join of the road-type constants, defaults for unknown types."""
    dim = F.broadcast(road_type_dim(spark)).withColumnRenamed("road_type", "_rt")
    j = df.join(dim, F.col(road_type) == F.col("_rt"), "left").drop("_rt")
    return j.withColumn("default_maxspeed", F.coalesce("default_maxspeed", F.lit(DEFAULT_MAXSPEED)))


def edges_with_geometry(raw: DataFrame, nodes: DataFrame) -> DataFrame:
    """Keep edges whose two ends are known nodes, attach polyline and attributes.

    ``raw``: src, dst, edge_key, geometry (text), highway, maxspeed_raw.
    The polyline is the parsed geometry, or the straight line between the end
    nodes when the geometry is absent, bad or shorter than two points.
    """
    n = nodes.select("node_id", "lat", "lon")
    s = n.select(F.col("node_id").alias("src"), F.col("lat").alias("_slat"),
                 F.col("lon").alias("_slon"))
    d = n.select(F.col("node_id").alias("dst"), F.col("lat").alias("_dlat"),
                 F.col("lon").alias("_dlon"))
    j = raw.join(s, "src").join(d, "dst")
    straight = F.array(geo.point("_slat", "_slon"), geo.point("_dlat", "_dlon"))
    rt = parse_highway("highway")
    return j.select(
        "src", "dst", "edge_key",
        make_link_id("src", "dst", "edge_key").alias("link_id"),
        rt.alias("road_type"),
        parse_maxspeed("maxspeed_raw", rt, default_maxspeed(rt)).alias("maxspeed"),
        F.coalesce(geo.parse_linestring("geometry"), straight).alias("poly"),
    )


def add_reverse_edges(edges: DataFrame) -> DataFrame:
    """Add the opposite direction of every edge (same link id, reversed polyline)."""
    both = edges.withColumn("is_reverse", F.explode(F.array(F.lit(False), F.lit(True))))  # the edges are made once
    back = F.col("is_reverse")
    return both.select(
        F.when(back, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(back, F.col("src")).otherwise(F.col("dst")).alias("dst"),
        "edge_key", "link_id", "road_type", "maxspeed",
        F.when(back, geo.reverse_polyline("poly")).otherwise(F.col("poly")).alias("poly"), "is_reverse")


def adjacency(edges: DataFrame) -> DataFrame:
    """A17, degrees: per node with out-edges, its out-degree and number of distinct targets."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"),
                                    F.countDistinct("dst").alias("n_targets"))


#: Out-edges in one row of an adjacency list.
LIST_EDGES = 1024


def adjacency_lists(nodes: DataFrame, edges: DataFrame, most: int = LIST_EDGES) -> DataFrame:
    """The out-edges of every node as lists, (node_id, chunk, n_edges, targets).

    A list holds ``most`` edges at most; a hub goes over several chunks, numbered from 0. Edges
    stand in the order of their link id (then target and the reversed copies), so the lists do not
    depend on arrival. Nodes without out-edges have one empty list, as in a map filled with all
    nodes first. No node's edges meet in one task: places come from a range sort.
    ``targets``: array<struct<dst, link_id, road_type, maxspeed, poly>>, of the last three those that
    ``edges`` has: columns that a caller does not need are best left out, as the rows are sorted and stored.
    """
    e = edges if "is_reverse" in edges.columns else edges.withColumn("is_reverse", F.lit(False))
    given = ["dst", "link_id", *[c for c in ("road_type", "maxspeed", "poly") if c in edges.columns]]
    e = with_place(e.select("src", "is_reverse", *given), ["src"], ["link_id", "dst", "is_reverse"], "_place")
    target = F.struct("_place", *given)
    lists = e.groupBy("src", F.floor(F.col("_place") / most).alias("chunk")).agg(F.array_sort(F.collect_list(target)).alias("targets"))
    lists = lists.select("src", "chunk", F.transform("targets", lambda t: t.dropFields("_place")).alias("targets"))
    none = F.array().cast(lists.schema["targets"].dataType)
    return (nodes.select("node_id").join(lists, F.col("node_id") == F.col("src"), "left")
            .select("node_id", F.coalesce("chunk", F.lit(0)).alias("chunk"), F.coalesce("targets", none).alias("targets"))
            .select("node_id", "chunk", F.size("targets").alias("n_edges"), "targets"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node count, edge count and total length in km, the edges read once."""
    nothing = F.lit(None).cast("double").alias("m")
    rows = nodes.select(F.lit(True).alias("is_node"), nothing).unionByName(
        edges.select(F.lit(False).alias("is_node"), geo.polyline_length("poly").alias("m")))
    return rows.agg(F.count_if("is_node").alias("nodes"), F.count_if(~F.col("is_node")).alias("edges"),
                    (F.sum("m") / 1000.0).alias("total_km"))


def link_geo(edges: DataFrame) -> DataFrame:
    """One midpoint and bearing per link id, of the first edge that has it.

    Edges without a key of their own share a link id between the same two nodes. Forward edges come
    before reversed copies, then the smaller (src, dst, edge key) and polyline, so the pick does not
    depend on how the file is cut.
    """
    e = edges if "is_reverse" in edges.columns else edges.withColumn("is_reverse", F.lit(False))
    order = ["is_reverse", "src", "dst", *(["edge_key"] if "edge_key" in e.columns else []), "poly"]
    # a generator, through which the filter is not pushed: the line is made once
    e = e.select("link_id", *order[:-1], F.explode(F.array("poly")).alias("poly")).filter(F.size("poly") >= 2)
    one = first_by_key(e, ["link_id"], [F.col(c).asc() for c in order])
    mb = F.col("_mb")
    return geo.with_midpoint(one, "poly", "_mb").select(
        "link_id", mb["mid_lat"].alias("mid_lat"), mb["mid_lon"].alias("mid_lon"),
        mb["bearing"].alias("bearing"))
