"""Model-quality aggregates computed as Spark aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.operators.ranks import running_total


def auc_by_group(df: DataFrame, groups: Sequence[str], score: str, label: str,
                 name: str = "auc") -> DataFrame:
    """ROC-AUC per group over the exact scores (Mann-Whitney: ties count one half).

    1. count positives and negatives per (group, score) - partial aggregate;
    2. running count of negatives below each score over range-sorted rows: the ranges come from
       a sample of the scores, so scores that crowd in one place are dealt out evenly;
    3. AUC = sum(pos * (neg_below + neg / 2)) / (P * N); NULL with one class.
    Rows without a score are left out.
    """
    g = (df.filter(F.col(score).isNotNull()).groupBy(*groups, F.col(score).alias("_score"))
         .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")))
    g = running_total(g, groups, ["_score"], F.col("_neg"), "_below")
    out = g.groupBy(*groups).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") * 0.5)).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                 F.col("_u") / (F.col("_p").cast("double") * F.col("_n")))
    return out.select(*groups, auc.alias(name), F.col("_p").alias("positives"),
                      F.col("_n").alias("negatives"))


def accuracy(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """Share of rows with ``pred == actual`` (0 when there are no rows)."""
    return df.agg(F.coalesce(F.avg((F.col(pred) == F.col(actual)).cast("double")),
                             F.lit(0.0)).alias("accuracy"))
