"""Daily evaluation runs of the stored scores -> a ``model_runs`` log.

For every day of transactions: version ``dYYYYMMDD``, trained_at = day start,
n_train = transactions before that day, n_test = that day's transactions,
metric = ROC-AUC (4 decimals) of that day's stored probabilities against the
labels (NULL with one class). The panels L1 and L7 read this log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehound.functions.scalar import round_half_up
from lakehound.operators.metrics import auc_by_group


def daily_model_runs(p: DataFrame, t: DataFrame) -> DataFrame:
    day = F.date_trunc("day", F.col("created_at")).alias("day")
    scored = (p.select("tx_uuid", "fraud_probability")
              .join(t.select("tx_uuid", "created_at", "is_fraud"), "tx_uuid")
              .select(day, "fraud_probability", "is_fraud"))
    auc = auc_by_group(scored, ["day"], "fraud_probability", "is_fraud", "auc")
    daily = t.groupBy(day).agg(F.count(F.lit(1)).alias("n_test"))
    # one row per day: the running total is a small window over days
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    daily = daily.withColumn("n_train", F.coalesce(F.sum("n_test").over(before), F.lit(0)))
    return (daily.join(auc.select("day", "auc"), "day", "left")
            .select(F.concat(F.lit("d"), F.date_format("day", "yyyyMMdd")).alias("model_version"),
                    F.col("day").alias("trained_at"),
                    F.col("n_train").cast("long").alias("n_train"),
                    F.col("n_test").cast("long").alias("n_test"),
                    round_half_up("auc", 4).alias("metric")))
