"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm.shared import saved


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _linked(rows: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest neighbour m of u; least neighbours meet by partial aggregation first."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"))
    return rows.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v): the least node that can be reached.

    Every round is one large star (links to larger neighbours move to the least one) and one small
    star (the same for smaller ones), written to the shared folder; rounds grow with the logarithm
    of the nodes. Links of a node to itself and repeats are ignored.
    """
    u, v = F.col("u"), F.col("v")
    edges = saved(links.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        large = _linked(both).filter(v > u).select(v.alias("u"), F.least("m", "u").alias("v"))
        # the least neighbour itself, where it is larger than u, keeps its link to u
        small = _linked(large.filter(u != v).distinct())
        edges = small.select(F.when(v == F.col("m"), u).otherwise(v).alias("u"), F.col("m").alias("v"))
        edges = saved(edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    return edges.select(u.alias("node"), v.alias("component")).unionByName(edges.select(v.alias("node"), v.alias("component")).distinct())
