"""Fraud monitoring panels as DataFrame queries.

Inputs are the merged (one row per key) ``transactions`` and ``predictions``
tables and the ``model_runs`` log; every function returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions.scalar import dow_sun1, hour_of, round_half_up
from lakehound.operators import aggregates as A
from lakehound.operators.filters import time_filter
from lakehound.operators.joins import scored_transactions, unscored
from lakehound.operators.topk import newest, newest_joined, time_cut, top_k


def total_transactions(t: DataFrame) -> DataFrame:
    """A1: number of transactions."""
    return A.row_count(t, "total")


def scored_count(p: DataFrame) -> DataFrame:
    """A1: number of scored transactions."""
    return A.row_count(p, "scored")


def predicted_fraud(p: DataFrame) -> DataFrame:
    """A2: number of predictions with label 1."""
    return A.count_where(p, F.col("pred_label") == 1, "fraud")


def throughput(t: DataFrame, lo=None, hi=None) -> DataFrame:
    """A4: events per minute and source inside [lo, hi]."""
    t = time_filter(t.select("created_at", "source"), "created_at", lo, hi)
    return A.per_minute(t, "created_at", ["source"], events=F.count(F.lit(1)))


def throughput_series(t: DataFrame, sources, lo=None, hi=None) -> DataFrame:
    """The throughput panel with one column per source (absent minute -> 0)."""
    return A.to_series(throughput(t, lo, hi), "time", "source", "events", sources, fill=0)


def fraud_rate(p: DataFrame, t: DataFrame, lo=None, hi=None) -> DataFrame:
    """A5: mean predicted label per minute of transaction time."""
    t = time_filter(t.select("tx_uuid", "created_at"), "created_at", lo, hi)
    j = scored_transactions(p.select("tx_uuid", "pred_label"), t)
    return A.per_minute(j, "created_at", fraud_rate=F.avg("pred_label"))


def last_fraud_rate(p: DataFrame, t: DataFrame, lo=None, hi=None) -> DataFrame:
    """A14 on A5: the stat-panel value (last non-null point of the series)."""
    return A.last_not_null(fraud_rate(p, t, lo, hi), "time", "fraud_rate")


def country_risk(p: DataFrame, t: DataFrame) -> DataFrame:
    """Per country the count, mean probability (3 decimals) and predicted frauds."""
    j = scored_transactions(p, t, ["fraud_probability", "pred_label"], ["country"])
    return (j.groupBy("country")
            .agg(F.count(F.lit(1)).alias("n"),
                 round_half_up(F.avg("fraud_probability"), 3).alias("avg_prob"),
                 F.sum("pred_label").cast("long").alias("predicted_fraud"))
            .orderBy(F.col("avg_prob").desc(), F.col("country")))


def risk_map(p: DataFrame, t: DataFrame, n: int = 2000) -> DataFrame:
    """L2: coordinates and probability of the ``n`` most recently scored transactions."""
    j = newest_joined(p, "scored_at", n, lambda p: scored_transactions(p, t, ["fraud_probability", "scored_at"], ["latitude", "longitude"]))
    return top_k(j, ["scored_at"], n, ["tx_uuid"]).select("latitude", "longitude",
                                                          "fraud_probability")


def latest_scores(p: DataFrame, n: int = 50000) -> DataFrame:
    """L3: the ``n`` most recent probabilities."""
    return top_k(newest(p, "scored_at", n), ["scored_at"], n, ["tx_uuid"]).select("tx_uuid", "fraud_probability")


def score_histogram(p: DataFrame, n: int = 50000, buckets: int = 30) -> DataFrame:
    """Equal-width histogram of the latest ``n`` scores between their min and max.

    The top value falls in the last bucket (not one past it); a constant
    series puts everything in bucket 1.
    """
    s = latest_scores(p, n)
    bounds = s.agg(F.min("fraud_probability").alias("lo"), F.max("fraud_probability").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    x = F.col("fraud_probability")
    raw = F.floor((x - lo) / (hi - lo) * buckets).cast("int") + 1
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(buckets)))
    return (s.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy("bucket"))


def recent_scored(p: DataFrame, t: DataFrame, n: int = 100) -> DataFrame:
    """L4: the ``n`` newest transactions with their score, amounts rounded."""
    columns = ["created_at", "source", "country", "device", "merchant_category", "amount"]
    j = newest_joined(t, "created_at", n, lambda t: scored_transactions(p, t, ["fraud_probability", "pred_label"], columns))
    return top_k(j, ["created_at"], n, ["tx_uuid"]).select(
        "created_at", "source", "country", "device",
        F.col("merchant_category").alias("category"),
        round_half_up("amount", 2).alias("amount"),
        round_half_up("fraud_probability", 3).alias("fraud_prob"),
        F.col("pred_label").alias("pred"))


def unscored_features(t: DataFrame, p: DataFrame, limit: int | None = None) -> DataFrame:
    """J3 + L6: transactions without a score, with scoring features.

    With ``limit`` it is the scorer's batch: oldest first, key as tie-break (X13), taken from the oldest
    hours that hold so many rows without a score.
    """
    if limit is not None:
        cut = time_cut(unscored(t.select("tx_uuid", "created_at"), p), "created_at", limit, newest_first=False)
        t = t.filter(cut.isNull() | F.col("created_at").isNull() | (F.col("created_at") < cut + F.expr("INTERVAL 1 HOUR")))
    rows = unscored(t.select("tx_uuid", "amount", "merchant_category", "country", "device",
                             "created_at"), p)
    rows = rows.select("tx_uuid", "amount", "merchant_category", "country", "device",
                       hour_of("created_at").alias("hour"), dow_sun1("created_at").alias("dow"),
                       "created_at")
    if limit is not None:
        rows = rows.orderBy("created_at", "tx_uuid").limit(limit)
    return rows


def latest_metric(mr: DataFrame, metric: str = "metric") -> DataFrame:
    """L1: metric of the most recently trained model."""
    return top_k(mr, ["trained_at"], 1, ["model_version"]).select(metric)


def model_history(mr: DataFrame, metric: str = "metric") -> DataFrame:
    """Metric per training time."""
    return mr.select(F.col("trained_at").alias("time"), metric).orderBy("time")
