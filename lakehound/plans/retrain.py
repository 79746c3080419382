"""Retrain cycle (M14): features -> challenger -> champion, stopping at the first failure.

Each step writes its output to shared storage before the next one reads it,
so the lineage is cut between steps and a lost executor only repeats the
current step.
"""

from __future__ import annotations

import os
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehound.operators.dedup import latest_by_key
from lakehound.plans import registry
from lakehound.plans.features import congestion_features, fraud_features
from lakehound.plans.training import MAX_DEPTH, N_TREES, train_congestion, train_fraud
from lakehound.sources.sinks import read_features, write_features


class StepFailed(RuntimeError):
    pass


def retrain(spark: SparkSession, rows: DataFrame, root: str, name: str = "fraud", kind: str = "fraud",
            n_trees: int = N_TREES, max_depth: int = MAX_DEPTH, promote_on_tie: bool = True) -> dict:
    """Run features, train + register + alias challenger, then the promotion gate.

    ``kind`` is "fraud" (``rows`` are transactions, metric ROC-AUC) or "congestion" (vehicle positions, accuracy).
    """
    report: dict = {}
    key, features, train, metric = {
        "fraud": ("tx_uuid", fraud_features, train_fraud, "roc_auc"),
        "congestion": ("pos_uuid", partial(congestion_features, keep=["pos_uuid"]),
                       partial(train_congestion, key="pos_uuid"), "accuracy")}[kind]
    try:
        latest = latest_by_key(rows, [key],
                               [F.col("id").desc(), F.col("created_at").desc()])
        path = os.path.join(root, "features", name)
        report["features_rows"] = write_features(features(latest), path)
    except Exception as ex:  # noqa: BLE001
        raise StepFailed(f"features: {ex}") from ex
    try:
        feats = read_features(spark, path)
        result = train(feats, n_trees=n_trees, max_depth=max_depth)
        version = registry.register_model(spark, root, name, result, metric, feats.schema)
        registry.set_alias(spark, root, name, registry.CHALLENGER, version)
        report.update(version=version, **result.metrics)
    except Exception as ex:  # noqa: BLE001
        raise StepFailed(f"train: {ex}") from ex
    try:
        report["gate"] = registry.promote(spark, root, name, promote_on_tie)
    except Exception as ex:  # noqa: BLE001
        raise StepFailed(f"promote: {ex}") from ex
    return report
