"""Road monitoring panels.

Inputs: merged ``vehicle_positions``, ``congestion_pred`` and the ``link_geo``
dimension. Windows are relative to ``as_of``: a timestamp, a Column, ``None``
(now) or ``"max"`` (newest row of the input, for stored data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions.scalar import congestion_level, round_half_up
from lakehound.operators import aggregates as A
from lakehound.operators.filters import recent, time_filter
from lakehound.operators.joins import with_dimension
from lakehound.operators.topk import top_k


def position_count(pos: DataFrame) -> DataFrame:
    """A1: number of stored positions."""
    return A.row_count(pos, "positions")


def active_vehicles(pos: DataFrame, as_of=None, window: str = "30 SECONDS") -> DataFrame:
    """A3: distinct vehicles seen inside the window."""
    return A.distinct_count(recent(pos.select("vehicle_id", "created_at"), "created_at",
                                   window, as_of), "vehicle_id", "vehicles")


def link_stats(pos: DataFrame, as_of=None, window: str = "5 MINUTES") -> DataFrame:
    """Per link inside the window: mean speed, count and newest time."""
    r = recent(pos.select("link_id", "speed_kmh", "created_at"), "created_at", window, as_of)
    return r.groupBy("link_id").agg(F.avg("speed_kmh").alias("s"),
                                    F.count(F.lit(1)).alias("n"),
                                    F.max("created_at").alias("last_seen"))


def congested_links(pos: DataFrame, as_of=None, window: str = "5 MINUTES",
                    min_n: int = 10) -> DataFrame:
    """A10: number of links with at least ``min_n`` observations and mean speed below 12."""
    s = link_stats(pos, as_of, window)
    return A.row_count(s.filter((F.col("n") >= min_n) & (F.col("s") < 12)), "congested_links")


def link_congestion(pos: DataFrame, as_of=None, window: str = "5 MINUTES",
                    fresh: str = "60 SECONDS", min_n: int = 10) -> DataFrame:
    """Rolling mean speed per link -> level, count, newest time.

    Keeps links with at least ``min_n`` observations that were seen within
    ``fresh`` of ``as_of``.
    """
    s = link_stats(pos, as_of, window)
    if isinstance(as_of, str) and as_of == "max":
        ref = pos.agg(F.max("created_at")).scalar()
    elif as_of is None:
        ref = F.current_timestamp()
    else:
        ref = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    return (s.filter((F.col("n") >= min_n)
                     & (F.col("last_seen") > ref - F.expr(f"INTERVAL {fresh}")))
            .select("link_id", congestion_level(F.col("s")).alias("congestion"), "n",
                    round_half_up("s", 2).alias("avg_speed"), "last_seen"))


def congestion_map(pos: DataFrame, link_geo: DataFrame, as_of=None, window: str = "5 MINUTES",
                   fresh: str = "60 SECONDS", min_n: int = 10,
                   all_links: bool = False) -> DataFrame:
    """Link congestion placed at the link midpoints.

    With ``all_links`` (J4) every link of the dimension is returned and links
    without data have NULL congestion (drawn grey). The aggregate is computed
    before the join, so the join sees one row per link on both sides.
    """
    c = link_congestion(pos, as_of, window, fresh, min_n)
    geo = link_geo.select("link_id", F.col("mid_lat").alias("latitude"),
                          F.col("mid_lon").alias("longitude"), "bearing")
    if all_links:
        # One row per link on the right, at most as many rows as the dimension.
        j = geo.join(c, "link_id", "left")
    else:
        j = with_dimension(c, geo, "link_id", how="inner")
    return j.select("latitude", "longitude", "bearing", "congestion", "n", "avg_speed", "link_id")


def last_position(pos: DataFrame, as_of=None, window: str = "30 SECONDS") -> DataFrame:
    """Newest position of each vehicle seen inside the window."""
    r = recent(pos.select("vehicle_id", "latitude", "longitude", "speed_kmh", "link_id",
                          "created_at"), "created_at", window, as_of)
    return A.last_by(r, "vehicle_id", "created_at",
                     ["latitude", "longitude", "speed_kmh", "link_id"])


def speed_by_road_type(pos: DataFrame, lo=None, hi=None) -> DataFrame:
    """Mean speed per minute and road type."""
    p = time_filter(pos.select("created_at", "road_type", "speed_kmh"), "created_at", lo, hi)
    return A.per_minute(p, "created_at", ["road_type"], avg_speed=F.avg("speed_kmh"))


def mean_congestion(cp: DataFrame, lo=None, hi=None) -> DataFrame:
    """Mean predicted level per minute of event time."""
    p = time_filter(cp.select("event_time", "pred_congestion"), "event_time", lo, hi)
    return A.per_minute(p, "event_time", avg_congestion=F.avg("pred_congestion"))


def pred_vs_actual(cp: DataFrame) -> DataFrame:
    """Per road type the count and mean predicted / actual level (2 decimals)."""
    return (cp.groupBy("road_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 round_half_up(F.avg("pred_congestion"), 2).alias("pred_avg"),
                 round_half_up(F.avg("actual_congestion"), 2).alias("actual_avg"))
            .orderBy(F.col("n").desc(), F.col("road_type")))


def recent_congestion(cp: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest congestion predictions."""
    return top_k(cp, ["scored_at"], n, ["pos_uuid"]).select(
        "event_time", "vehicle_id", "road_type", "link_id", "sim_hour", "pred_congestion",
        "actual_congestion", round_half_up("pred_proba", 3).alias("prob"))
