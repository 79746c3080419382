"""GraphML road-graph source.

Read with Spark's XML source, one row per ``<node>`` and ``<edge>`` element,
so a large graph splits across tasks like any file. ``<data>`` children are
read as an explicit array (a single child would otherwise be inferred as a
struct). Attribute names are resolved in the row itself: the ``<key>``
declarations of the five attributes in use are read once and turned into a key-id filter per attribute, so
nodes and edges need no explode, join or shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.operators.roadgraph import add_reverse_edges, edges_with_geometry

#: The attributes that a road graph is read for.
ATTRIBUTES = ("x", "y", "geometry", "highway", "maxspeed")

_DATA = T.ArrayType(T.StructType([T.StructField("_key", T.StringType()),
                                  T.StructField("_VALUE", T.StringType())]))
_KEY = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_for", T.StringType()),
                     T.StructField("_attr.name", T.StringType())])
_NODE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("data", _DATA)])
_EDGE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_source", T.StringType()),
                      T.StructField("_target", T.StringType()), T.StructField("data", _DATA)])


def _xml(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    return (spark.read.format("xml").option("rowTag", tag).option("valueTag", "_VALUE")
            .option("attributePrefix", "_").option("ignoreNamespace", "true")
            .schema(schema).load(path))


def read_keys(spark: SparkSession, path: str) -> dict[tuple[str, str], list[str]]:
    """(element kind, attribute name) -> key ids of ``ATTRIBUTES``; kind ``all`` applies to both."""
    rows = (_xml(spark, path, "key", _KEY).select("_id", "_for", F.col("`_attr.name`").alias("name"))
            .filter(F.col("name").isin(*ATTRIBUTES)).distinct().collect())
    out: dict[tuple[str, str], list[str]] = {}
    for r in rows:
        out.setdefault((r["_for"] or "all", r["name"]), []).append(r["_id"])
    return out


def _attr(keys, kind: str, name: str) -> Column:
    ids = keys.get((kind, name), []) + keys.get(("all", name), [])
    if not ids:
        return F.lit(None).cast("string")
    hit = F.filter("data", lambda d: d["_key"].isin(*ids))
    return F.try_element_at(hit, F.lit(1))["_VALUE"]


def read_graphml(spark: SparkSession, path: str, directed: bool | None = None):
    """Nodes and edges of a GraphML road graph.

    Nodes need both ``x`` (lon) and ``y`` (lat); edges need both ends among
    the nodes. ``directed=None`` follows the file's ``edgedefault``; an
    undirected graph gets reverse edges (U2). Returns ``(nodes, edges)``.
    """
    keys = read_keys(spark, path)
    nodes = (_xml(spark, path, "node", _NODE)
             .select(F.col("_id").alias("node_id"),
                     _attr(keys, "node", "y").try_cast("double").alias("lat"),
                     _attr(keys, "node", "x").try_cast("double").alias("lon"))
             .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()))
    raw = _xml(spark, path, "edge", _EDGE).select(
        F.col("_source").alias("src"), F.col("_target").alias("dst"),
        F.col("_id").alias("edge_key"),
        _attr(keys, "edge", "geometry").alias("geometry"),
        _attr(keys, "edge", "highway").alias("highway"),
        _attr(keys, "edge", "maxspeed").alias("maxspeed_raw"))
    edges = edges_with_geometry(raw, nodes)
    if directed is None:
        directed = graph_is_directed(spark, path)
    if not directed:
        edges = add_reverse_edges(edges)
    return nodes, edges


def graph_is_directed(spark: SparkSession, path: str) -> bool:
    """``edgedefault`` of the ``<graph>`` element (directed unless it says undirected)."""
    v = (spark.read.text(path).filter(F.col("value").contains("<graph"))
         .select(F.regexp_extract("value", r'edgedefault="(\w+)"', 1).alias("d"))
         .filter(F.col("d") != "").limit(1).collect())
    return not (v and v[0]["d"] == "undirected")


def _escaped(c: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(mark), F.lit(name))
    return c


def write_graphml(nodes: DataFrame, edges: DataFrame, folder: str, directed: bool = True) -> None:
    """Write a road graph as a folder of GraphML documents, one element a line; NULL attributes are left out.

    ``nodes``: node_id, lat, lon. ``edges``: src, dst, edge_key, geometry, highway, maxspeed_raw (texts).
    """
    def data(key: str, column: str) -> Column:
        return F.concat(F.lit(f'<data key="{key}">'), _escaped(F.col(column).cast("string")), F.lit("</data>"))

    def given(name: str, column: str) -> Column:
        return F.concat(F.lit(f' {name}="'), _escaped(F.col(column).cast("string")), F.lit('"'))

    used = (("lat", "node", "y"), ("lon", "node", "x"), ("geometry", "edge", "geometry"), ("highway", "edge", "highway"), ("maxspeed_raw", "edge", "maxspeed"))
    head = ["<graphml>", *(f'<key id="{c}" for="{kind}" attr.name="{name}" attr.type="string"/>' for c, kind, name in used),
            f'<graph edgedefault="{"directed" if directed else "undirected"}">']
    parts = (nodes.select(F.concat(F.lit("<node"), given("id", "node_id"), F.lit(">"), F.concat_ws("", *[data(c, c) for c, kind, _ in used if kind == "node"]),
                                   F.lit("</node>")).alias("value")),
             edges.select(F.concat(F.lit("<edge"), F.concat_ws("", given("source", "src"), given("target", "dst"), given("id", "edge_key")), F.lit(">"),
                                   F.concat_ws("", *[data(c, c) for c, kind, _ in used if kind == "edge"]), F.lit("</edge>")).alias("value")))
    for part in parts:
        part.mapInArrow(_document(head, ["</graph>", "</graphml>"]), "value string").write.mode("append").text(folder)


def _document(head: list[str], foot: list[str]):
    """Every partition as a document of its own."""
    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": head})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], names=["value"])
        yield pa.RecordBatch.from_pydict({"value": foot})
    return document
