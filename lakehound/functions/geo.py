"""Geometry on (lat, lon) points and polylines as native column expressions.

A polyline is ``array<struct<lat: double, lon: double>>`` held in one row, so
length, point-at-distance and midpoint are per-row higher-order functions:
no shuffle, no grouping, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehound.functions.scalar import EARTH_RADIUS_M


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(lat, lon) -> Column:
    """A polyline vertex."""
    return F.struct(_c(lat).cast("double").alias("lat"), _c(lon).cast("double").alias("lon"))


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """F16: great-circle distance in metres, R = 6 371 000 m."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = F.radians(_c(lat2) - _c(lat1))
    dl = F.radians(_c(lon2) - _c(lon1))
    x = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(x))


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """initial bearing from point 1 to point 2, degrees, north 0, clockwise, [0, 360)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dl = F.radians(_c(lon2) - _c(lon1))
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return (F.degrees(F.atan2(y, x)) + 360.0) % 360.0


def _seg_len(a: Column, b: Column) -> Column:
    return haversine(a["lat"], a["lon"], b["lat"], b["lon"])


def segments(poly) -> Column:
    """Consecutive vertex pairs with their length: array<struct<a, b, len>>."""
    p = _c(poly)
    n = F.size(p)
    heads = F.slice(p, 1, n - 1)
    tails = F.slice(p, 2, n - 1)
    return F.zip_with(heads, tails, lambda a, b: F.struct(a.alias("a"), b.alias("b"),
                                                          _seg_len(a, b).alias("len")))


def polyline_length(poly) -> Column:
    """Total length in metres (sum of segment haversines, left to right)."""
    return F.aggregate(segments(poly), F.lit(0.0), lambda acc, s: acc + s["len"])


def cumulative_distance(df: DataFrame, key: str, poly: str) -> DataFrame:
    """One row per vertex, (key, vertex, lat, lon, distance_m), the running distance from the line's start.

    The vertices of a line are taken apart and summed in a running window over ``key`` (one line
    each), in proportion to their number: a line of very many vertices costs no more per vertex.
    """
    rows = df.select(key, F.posexplode(poly).alias("vertex", "_p"))
    line = Window.partitionBy(key).orderBy("vertex")
    back = F.lag("_p").over(line)
    rows = rows.withColumn("_step", F.coalesce(_seg_len(back, F.col("_p")), F.lit(0.0)))
    return rows.select(key, "vertex", F.col("_p.lat").alias("lat"), F.col("_p.lon").alias("lon"),
                       F.sum("_step").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("distance_m"))


def _interp(a: Column, b: Column, f: Column) -> Column:
    return F.struct((a["lat"] + (b["lat"] - a["lat"]) * f).alias("lat"),
                    (a["lon"] + (b["lon"] - a["lon"]) * f).alias("lon"))


def walk(segs, target, clamp_f: bool) -> Column:
    """First segment whose running end reaches ``target`` (else the last one).

    ``segs`` is a segment array (see :func:`segments`), best a materialised
    column so the haversines are computed once. One ``aggregate`` pass keeps
    (running distance, index, chosen index, chosen start). Returns
    struct(seg, f): the segment and the fraction along it.
    """
    sg = _c(segs)
    tgt = _c(target)
    n = F.size(sg)
    init = F.struct(F.lit(0.0).alias("pos"), F.lit(0).alias("i"), F.lit(0).alias("k"),
                    F.lit(0.0).alias("kstart"))

    def step(st, s):
        i = st["i"] + 1
        take = (st["k"] == 0) & ((st["pos"] + s["len"] >= tgt) | (i == n))
        return F.struct((st["pos"] + s["len"]).alias("pos"), i.alias("i"),
                        F.when(take, i).otherwise(st["k"]).alias("k"),
                        F.when(take, st["pos"]).otherwise(st["kstart"]).alias("kstart"))

    st = F.aggregate(sg, init, step)
    seg = F.element_at(sg, st["k"])
    d = tgt - st["kstart"]
    f = F.when(seg["len"] > 0, d / seg["len"]).otherwise(F.lit(0.0))
    if clamp_f:
        f = F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0))
    return F.struct(seg.alias("seg"), f.alias("f"))


def segments_length(segs) -> Column:
    """Total length of a segment array."""
    return F.aggregate(_c(segs), F.lit(0.0), lambda acc, s: acc + s["len"])


def point_at_segments(segs, first, d) -> Column:
    """G5 on a materialised segment array; ``first`` is the polyline's first vertex."""
    w = walk(segs, d, clamp_f=False)
    moved = _interp(w["seg"]["a"], w["seg"]["b"], w["f"])
    return F.when(_c(d) <= 0, _c(first)).otherwise(moved)


def midpoint_and_bearing_segments(segs) -> Column:
    """G6 on a materialised segment array."""
    w = walk(segs, segments_length(segs) / 2.0, clamp_f=True)
    a, b = w["seg"]["a"], w["seg"]["b"]
    mid = _interp(a, b, w["f"])
    return F.struct(mid["lat"].alias("mid_lat"), mid["lon"].alias("mid_lon"),
                    bearing(a["lat"], a["lon"], b["lat"], b["lon"]).alias("bearing"))


def point_at(poly, d) -> Column:
    """Point at distance ``d`` metres along the polyline.

    ``d <= 0`` gives the first vertex; past the end the last segment is
    extrapolated (fraction above 1), as the simulator does. For large inputs
    prefer :func:`with_point_at`, which computes the segments once.
    """
    p = _c(poly)
    return point_at_segments(segments(p), F.element_at(p, 1), d)


def with_point_at(df, poly: str, d, name: str):
    """DataFrame form of G5: segment array materialised once per row."""
    out = df.withColumn("_segs", segments(poly))
    return out.withColumn(name, point_at_segments("_segs", F.element_at(F.col(poly), 1), d)) \
        .drop("_segs")


def with_midpoint(df, poly: str, name: str):
    """DataFrame form of G6: segment array materialised once per row."""
    out = df.withColumn("_segs", segments(poly))
    return out.withColumn(name, midpoint_and_bearing_segments("_segs")).drop("_segs")


def parse_linestring(text) -> Column:
    """``LINESTRING (lon lat, lon lat, ...)`` -> polyline of (lat, lon).

    Bad text, an unparseable number or fewer than two points give NULL.
    """
    t = _c(text)
    inner = F.regexp_extract(t, r"\(([^()]*)\)", 1)
    pairs = F.split(F.trim(inner), r"\s*,\s*")
    pts = F.transform(pairs, lambda s: F.split(F.trim(s), r"\s+"))
    poly = F.transform(pts, lambda xy: F.struct(
        F.try_element_at(xy, F.lit(2)).try_cast("double").alias("lat"),
        F.try_element_at(xy, F.lit(1)).try_cast("double").alias("lon")))

    def good(p: Column) -> Column:
        return F.when((F.size(p) >= 2) & F.forall(p, lambda q: q["lat"].isNotNull() & q["lon"].isNotNull()), p)

    # the line is named by a lambda's variable, so that it is parsed once and not for every use
    return F.when(t.isNotNull() & (inner != ""), F.get(F.transform(F.array(poly), good), 0))


def reverse_polyline(poly) -> Column:
    """Vertices in reverse order."""
    return F.reverse(_c(poly))
