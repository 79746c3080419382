"""Road graph: GraphML read, geometry fallbacks, attributes, link midpoints."""

import math

from pyspark.sql import functions as F

from lakehound.functions import geo
from lakehound.operators import roadgraph as G
from lakehound.sources.graphml import read_graphml

GRAPHML = """<?xml version='1.0' encoding='utf-8'?>
<graphml xmlns="http://graphml.graphdrawing.org/xmlns">
  <key id="d4" for="node" attr.name="y" attr.type="string"/>
  <key id="d5" for="node" attr.name="x" attr.type="string"/>
  <key id="d10" for="edge" attr.name="highway" attr.type="string"/>
  <key id="d11" for="edge" attr.name="maxspeed" attr.type="string"/>
  <key id="d14" for="edge" attr.name="geometry" attr.type="string"/>
  <graph edgedefault="directed">
    <node id="1"><data key="d4">35.0</data><data key="d5">135.0</data></node>
    <node id="2"><data key="d4">35.0</data><data key="d5">135.01</data></node>
    <node id="3"><data key="d4">35.01</data><data key="d5">135.01</data></node>
    <node id="4"><data key="d4">35.01</data><data key="d5">135.0</data></node>
    <node id="5"><data key="d4">35.02</data></node>
    <edge source="1" target="2" id="0"><data key="d10">primary</data><data key="d11">50</data></edge>
    <edge source="2" target="3" id="0"><data key="d10">['secondary', 'tertiary']</data><data key="d11">25 mph</data>
      <data key="d14">LINESTRING (135.01 35.0, 135.015 35.005, 135.01 35.01)</data></edge>
    <edge source="3" target="4" id="0"><data key="d10">motorway</data></edge>
    <edge source="4" target="1"><data key="d10">service</data><data key="d11">['30', '40']</data></edge>
    <edge source="4" target="9" id="0"><data key="d10">primary</data></edge>
  </graph>
</graphml>
"""


def hav(a, b):
    r = 6371000.0
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    dp, dl = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
    x = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * r * math.asin(math.sqrt(x))


def write(scratch):
    path = f"{scratch}/road.graphml"
    with open(path, "w") as f:
        f.write(GRAPHML)
    return path


def test_read_graph(spark, scratch):
    nodes, edges = read_graphml(spark, write(scratch))
    assert sorted(r.node_id for r in nodes.collect()) == ["1", "2", "3", "4"]  # 5 lacks x
    rows = {r.link_id: r for r in edges.collect()}
    # dangling edge 4->9 dropped; edge without id has a two-part link id
    assert sorted(rows) == ["1_2_0", "2_3_0", "3_4_0", "4_1"]
    assert rows["1_2_0"].road_type == "primary" and rows["1_2_0"].maxspeed == 50.0
    assert rows["2_3_0"].road_type == "secondary"
    assert abs(rows["2_3_0"].maxspeed - 25 * 1.60934) < 1e-9
    assert rows["3_4_0"].maxspeed == 100.0  # motorway default
    assert rows["4_1"].maxspeed == 30.0  # first number of a list
    assert len(rows["2_3_0"].poly) == 3 and rows["2_3_0"].poly[1].lat == 35.005
    assert [(p.lat, p.lon) for p in rows["1_2_0"].poly] == [(35.0, 135.0), (35.0, 135.01)]


def test_undirected_adds_reverse(spark, scratch):
    path = write(scratch)
    with open(path) as f:
        s = f.read().replace('edgedefault="directed"', 'edgedefault="undirected"')
    with open(path, "w") as f:
        f.write(s)
    _, edges = read_graphml(spark, path, directed=None)
    assert edges.count() == 8
    rev = edges.filter("src = '3' and dst = '2'").first()
    assert rev.link_id == "2_3_0" and rev.poly[0].lat == 35.01


def test_geometry_and_link_geo(spark, scratch):
    nodes, edges = read_graphml(spark, write(scratch))
    lg = {r.link_id: r for r in G.link_geo(edges).collect()}
    # straight edge: midpoint is the middle, heading east
    m = lg["1_2_0"]
    assert abs(m.mid_lat - 35.0) < 1e-12 and abs(m.mid_lon - 135.005) < 1e-9
    assert abs(m.bearing - 90.0) < 0.01
    # bent edge: two equal-length segments -> midpoint at the bend
    b = lg["2_3_0"]
    assert abs(b.mid_lat - 35.005) < 1e-6 and abs(b.mid_lon - 135.015) < 1e-6
    st = G.graph_stats(nodes, edges).first()
    assert st.nodes == 4 and st.edges == 4
    poly = [(35.0, 135.01), (35.005, 135.015), (35.01, 135.01)]
    assert abs(st.total_km * 1000 - (hav((35.0, 135.0), (35.0, 135.01)) + hav(poly[0], poly[1])
                                     + hav(poly[1], poly[2]) + hav((35.01, 135.01), (35.01, 135.0))
                                     + hav((35.01, 135.0), (35.0, 135.0)))) < 1e-6


def test_point_at(spark):
    df = spark.createDataFrame([(0,)], "i int").select(
        F.array(geo.point(F.lit(35.0), F.lit(135.0)), geo.point(F.lit(35.0), F.lit(135.01)),
                geo.point(F.lit(35.01), F.lit(135.01))).alias("poly"))
    L1 = hav((35.0, 135.0), (35.0, 135.01))
    L2 = hav((35.0, 135.01), (35.01, 135.01))
    out = df.select(geo.point_at("poly", F.lit(-5.0)).alias("a"),
                    geo.point_at("poly", F.lit(L1 / 2)).alias("b"),
                    geo.point_at("poly", F.lit(L1 + L2 / 2)).alias("c"),
                    geo.point_at("poly", F.lit(L1 + 2 * L2)).alias("d"),
                    geo.polyline_length("poly").alias("len")).first()
    assert (out.a.lat, out.a.lon) == (35.0, 135.0)
    assert abs(out.b.lon - 135.005) < 1e-9
    assert abs(out.c.lat - 35.005) < 1e-9
    assert abs(out.d.lat - 35.02) < 1e-9  # extrapolated past the end
    assert abs(out.len - (L1 + L2)) < 1e-6
    cum = geo.cumulative_distance(df.withColumn("i", F.lit(1)), "i", "poly").orderBy("vertex").collect()
    assert [round(r.distance_m, 6) for r in cum] == [0.0, round(L1, 6), round(L1 + L2, 6)]


def test_cumulative_distance_of_a_very_long_line(spark):
    n = 100_000
    line = spark.range(2).select("id", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: geo.point(k / 10_000 - 45, F.lit(7.0))).alias("poly"))
    got = geo.cumulative_distance(line, "id", "poly")
    step = hav((0.0, 7.0), (1 / 10_000, 7.0))
    last = got.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("distance_m").alias("m"), F.max_by("distance_m", "vertex").alias("end")).collect()
    assert all(r.n == n and r.m == r.end and abs(r.m - step * (n - 1)) < 1 for r in last)


def test_parse_linestring_bad(spark):
    df = spark.createDataFrame([("LINESTRING (1 2)",), ("LINESTRING (a b, 1 2)",), (None,),
                                ("LINESTRING (1 2, 3 4 5)",), ("garbage",)], "t string")
    out = [r.p for r in df.select(geo.parse_linestring("t").alias("p")).collect()]
    assert out[0] is None and out[1] is None and out[2] is None and out[4] is None
    assert [(p.lat, p.lon) for p in out[3]] == [(2.0, 1.0), (4.0, 3.0)]
