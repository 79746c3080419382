"""Streaming registered queries.

The derived transactions are written as JSON lines (the change-topic
payload) to a fresh folder under the shared checkpoint location, a stream
reads them with ``availableNow`` and writes its result to parquet, and the
query returns that parquet table.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lakehound.plans.catalog import register
from lakehound.plans.oracle import fraud, road
from lakehound.schemas import FRAUD_EVENT_FULL, ROAD_EVENT
from lakehound.session import shared_dir
from lakehound.sources import fixtures as X
from lakehound.sources.tables import Tables
from lakehound.streaming.changes import parse_change, read_change_stream, with_event_time
from lakehound.streaming.replay import END, files_per_batch, finished, state_by_file, stopped_and_resumed, write_in_order
from lakehound.streaming.scorer import start
from lakehound.streaming.windows import dedup_stream, link_congestion_stream, minute_counts_stream

DELAY = "10 minutes"


def _replay(spark, sf_dir, copies_every: int | None = None):
    """Write transactions as JSON change events; optionally repeat every n-th event."""
    root = shared_dir(spark, "stream")
    tx = X.transactions(Tables(spark, sf_dir))
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    events = tx.select(F.to_json(F.struct(*[F.col(c) for c in tx.columns]), fmt).alias("value"),
                       "id", "created_at")
    if copies_every:
        events = events.unionByName(events.filter(F.col("id") % copies_every == 0))
    write_in_order(events, os.path.join(root, "in"), '{"tx_uuid": "' + END + '", "source": "' + END + '", "created_at": "%s"}', "gzip")
    stream = parse_change(read_change_stream(spark, {"kind": "files", "max_files": files_per_batch(spark),
                                                     "path": os.path.join(root, "in")}),
                          FRAUD_EVENT_FULL)
    return root, with_event_time(stream)


@register("stream_minute_counts", fraud("""
SELECT date_trunc('minute', created_at) AS time, source, count(*) AS events FROM transactions
GROUP BY 1, 2"""))
def stream_minute_counts(spark, sf_dir):
    """Per-minute counts from the stream; windows closed by the watermark."""
    root, s = _replay(spark, sf_dir)
    out = os.path.join(root, "out")
    with state_by_file(spark):
        q = start(minute_counts_stream(s, DELAY), os.path.join(root, "ckpt"), path=out,
                  available_now=True)
    finished(q)
    return spark.read.parquet(out).filter(F.col("source") != END).select(F.col("time").cast("timestamp_ntz").alias("time"),
                                          "source", "events")


@register("stream_resumed", fraud("""
SELECT date_trunc('minute', created_at) AS time, source, count(*) AS events FROM transactions
GROUP BY 1, 2"""))
def stream_resumed(spark, sf_dir):
    """The minute counts under a processing-time trigger, stopped after a batch and resumed from the checkpoint."""
    root, s = _replay(spark, sf_dir)
    out = os.path.join(root, "out")

    def begin(**how):
        with state_by_file(spark):
            return start(minute_counts_stream(s, DELAY), os.path.join(root, "ckpt"), path=out, **how)

    stopped_and_resumed(begin)
    return spark.read.parquet(out).filter(F.col("source") != END).select(F.col("time").cast("timestamp_ntz").alias("time"),
                                          "source", "events")


@register("stream_dedup", fraud("""
SELECT tx_uuid, amount, created_at FROM transactions"""))
def stream_dedup(spark, sf_dir):
    """Every seventh event replayed; the stream keeps one per tx_uuid."""
    root, s = _replay(spark, sf_dir, copies_every=7)
    out = os.path.join(root, "out")
    with state_by_file(spark):
        q = start(dedup_stream(s, "tx_uuid", DELAY).select("tx_uuid", "amount", "created_at"),
                  os.path.join(root, "ckpt"), path=out, available_now=True)
    finished(q)
    return spark.read.parquet(out).filter(F.col("tx_uuid") != END).select(
        "tx_uuid", "amount", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@register("stream_link_congestion", road("""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, link_id,
  CASE WHEN avg(speed_kmh) < 12 THEN 2 WHEN avg(speed_kmh) < 24 THEN 1 ELSE 0 END AS congestion,
  count(*) AS n, CAST(round(CAST(avg(speed_kmh) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_speed
FROM (SELECT link_id, speed_kmh, date_trunc('minute', created_at) - to_minutes(r.k) AS ws
      FROM vehicle_positions, range(0, 5) r(k)) w
GROUP BY ws, link_id"""))
def stream_link_congestion(spark, sf_dir):
    """Positions replayed as change events; 5-minute windows sliding by 1 minute per link."""
    root = shared_dir(spark, "stream")
    pos = X.vehicle_positions(Tables(spark, sf_dir))
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    events = pos.select(F.to_json(F.struct(*[F.col(c) for c in pos.columns]), fmt).alias("value"), "created_at")
    write_in_order(events, os.path.join(root, "in"), '{"pos_uuid": "' + END + '", "link_id": "' + END + '", "created_at": "%s"}', "gzip")
    s = with_event_time(parse_change(read_change_stream(
        spark, {"kind": "files", "max_files": files_per_batch(spark), "path": os.path.join(root, "in")}), ROAD_EVENT))
    out = os.path.join(root, "out")
    with state_by_file(spark):
        q = start(link_congestion_stream(s, "1 minute", block=5), os.path.join(root, "ckpt"), path=out,
                  available_now=True)
    finished(q)
    return spark.read.parquet(out).filter(F.col("link_id") != END).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "link_id", "congestion", "n", "avg_speed")
