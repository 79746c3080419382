"""Event-time windows and dedup on streams.

All of them are append-mode stateful operators bounded by a watermark: a
window is emitted once the watermark passes its end, then its state is
dropped; rows older than the watermark are late and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions.scalar import congestion_level, round_half_up


def minute_counts_stream(df: DataFrame, delay: str = "10 minutes", ts: str = "created_at",
                         by: str = "source") -> DataFrame:
    """Events per tumbling minute and ``by`` column."""
    return (df.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 minute").alias("w"), by)
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("time"), by, "events"))


def _micros(df: DataFrame, *lengths: str) -> list[int]:
    """Lengths like ``5 minutes`` in microseconds."""
    at = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    return list(df.sparkSession.sql("SELECT " + ", ".join(
        f"timestampdiff(MICROSECOND, {at}, {at} + INTERVAL '{text}')" for text in lengths)).first())


def link_congestion_stream(df: DataFrame, delay: str = "1 minute", ts: str = "created_at",
                           length: str = "5 minutes", slide: str = "1 minute", block: int = 1) -> DataFrame:
    """Per link, mean speed over a 5-minute window sliding by 1 minute -> level.

    ``block`` windows that follow each other share one row of the state, so an event changes about
    ``1 + (length / slide - 1) / block`` rows of it, not ``length / slide``. They are emitted, and judge
    which events are late, together when the last of them ends; with 1 each window does so at its own end.
    """
    size, step = _micros(df, length, slide)
    kind = df.schema[ts].dataType
    start = F.unix_micros(F.col("w.start").cast("timestamp"))
    rows = (df.select(F.col(ts).alias("at"), "link_id", "speed_kmh").withWatermark("at", delay)
            .select("at", "link_id", "speed_kmh",
                    F.window("at", f"{(block - 1) * step + size} microseconds", f"{block * step} microseconds").alias("w"))
            .withColumn("since", F.unix_micros(F.col("at").cast("timestamp")) - start))
    sums, windows = [], []
    for k in range(block):
        inside = (F.col("since") >= k * step) & (F.col("since") < k * step + size)
        sums += [F.avg(F.when(inside, F.col("speed_kmh"))).alias(f"speed_{k}"), F.count(F.when(inside, 1)).alias(f"n_{k}")]
        windows.append(F.struct((start + k * step).alias("ws"), F.col(f"speed_{k}").alias("speed"), F.col(f"n_{k}").alias("n")))
    return (rows.groupBy("w", "link_id").agg(*sums)
            .select("link_id", F.inline(F.array(*windows))).filter("n > 0")
            .select(F.timestamp_micros("ws").cast(kind).alias("window_start"),
                    F.timestamp_micros(F.col("ws") + size).cast(kind).alias("window_end"),
                    "link_id", congestion_level(F.col("speed")).alias("congestion"), "n",
                    round_half_up(F.col("speed"), 2).alias("avg_speed")))


def dedup_stream(df: DataFrame, key: str = "tx_uuid", delay: str = "10 minutes",
                 ts: str = "created_at") -> DataFrame:
    """Drop replayed events with the same key seen within the watermark delay.

    Events without a key are no copies of each other and go (quarantine keeps them, X6).
    """
    return df.filter(F.col(key).isNotNull()).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
