"""Model-side registered queries: evaluation log, panels on it, training and scoring."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakehound.operators.dedup import latest_by_key
from lakehound.operators.metrics import auc_by_group
from lakehound.plans import fraud_panels as P
from lakehound.plans import registry
from lakehound.plans.catalog import register
from lakehound.plans.evaluation import daily_model_runs
from lakehound.functions.scalar import congestion_level, decision, round_half_up
from lakehound.plans.features import fraud_features
from lakehound.plans.oracle import fraud
from lakehound.plans.training import TrainResult, build_pipeline, stratified_split, train_congestion, train_fraud
from lakehound.schemas import FRAUD_CATEGORICAL, FRAUD_NUMERIC
from lakehound.session import shared_dir
from lakehound.sources import fixtures as X
from lakehound.sources.sinks import write_predictions
from lakehound.sources.tables import Tables
from lakehound.streaming.scorer import ModelCache, alias_lookup, drain_backlog

_RUNS_SQL = """,
scored AS (
  SELECT date_trunc('day', t.created_at) AS day, p.fraud_probability AS score, t.is_fraud AS label
  FROM predictions p JOIN transactions t ON p.tx_uuid = t.tx_uuid
),
steps AS (
  SELECT day, score AS step,
    CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
    CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
  FROM scored GROUP BY 1, 2
),
below AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY day ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM steps
),
auc AS (
  SELECT day, sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5)) AS u,
    sum(pos) AS p, sum(neg) AS n FROM below GROUP BY day
),
daily AS (
  SELECT date_trunc('day', created_at) AS day, count(*) AS n_test FROM transactions GROUP BY 1
),
model_runs AS (
  SELECT 'd' || strftime(d.day, '%Y%m%d') AS model_version, CAST(d.day AS TIMESTAMP) AS trained_at,
    CAST(coalesce(sum(d.n_test) OVER (ORDER BY d.day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS n_train,
    CAST(d.n_test AS BIGINT) AS n_test,
    CAST(round(CAST(CASE WHEN a.p > 0 AND a.n > 0 THEN a.u / (CAST(a.p AS DOUBLE) * CAST(a.n AS DOUBLE)) END AS DECIMAL(38,10)), 4) AS DOUBLE) AS metric
  FROM daily d LEFT JOIN auc a ON d.day = a.day
)
"""


def _runs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    return daily_model_runs(X.predictions(t, tx), tx)


@register("model_runs_daily", fraud(_RUNS_SQL + "SELECT * FROM model_runs"))
def model_runs_daily(spark, sf_dir):
    return _runs(spark, sf_dir)


@register("latest_metric", fraud(_RUNS_SQL + """
SELECT metric FROM model_runs ORDER BY trained_at DESC, model_version LIMIT 1"""))
def latest_metric(spark, sf_dir):
    return P.latest_metric(_runs(spark, sf_dir))


@register("model_history", fraud(_RUNS_SQL + """
SELECT trained_at AS time, metric FROM model_runs ORDER BY time"""))
def model_history(spark, sf_dir):
    return P.model_history(_runs(spark, sf_dir))


def _fraud_feats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    latest = latest_by_key(tx, ["tx_uuid"], [F.col("id").desc(), F.col("created_at").desc()])
    return t, tx, fraud_features(latest)


@register("split_counts", fraud("""
, sizes AS (SELECT is_fraud, count(*) AS n FROM transactions GROUP BY 1),
whole AS (SELECT *, floor(0.2::DOUBLE * n)::BIGINT AS w, ceil(0.2::DOUBLE * sum(n) OVER ()) - sum(floor(0.2::DOUBLE * n)) OVER () AS more FROM sizes),
sides AS (SELECT is_fraud, w + CASE WHEN row_number() OVER (ORDER BY 0.2::DOUBLE * n - w DESC, is_fraud) <= more THEN 1 ELSE 0 END AS k FROM whole),
placed AS (SELECT t.is_fraud, t.id, row_number() OVER (PARTITION BY t.is_fraud ORDER BY md5(t.tx_uuid || ':42'), t.tx_uuid) <= k AS test
  FROM transactions t JOIN sides s ON s.is_fraud = t.is_fraud)
SELECT is_fraud, count(*) FILTER (NOT test) AS n_train, count(*) FILTER (test) AS n_test,
  CAST(sum(id) FILTER (test) AS BIGINT) AS test_ids FROM placed GROUP BY is_fraud"""))
def split_counts(spark, sf_dir):
    """M3: rows of both sides per class, and the sum of the test rows' ids."""
    _, _, feats = _fraud_feats(spark, sf_dir)
    sides = [d.withColumn("test", F.lit(t)) for d, t in zip(stratified_split(feats, "is_fraud", "tx_uuid"), (False, True), strict=True)]
    return sides[0].unionByName(sides[1]).groupBy("is_fraud").agg(
        F.count_if(~F.col("test")).alias("n_train"), F.count_if("test").alias("n_test"),
        F.sum(F.when(F.col("test"), F.col("tx_uuid").cast("long"))).alias("test_ids"))


@register("eval_auc", fraud("""
, s AS (SELECT fraud_probability AS p, count(*) FILTER (is_fraud = 1) AS pos, count(*) FILTER (is_fraud = 0) AS neg
  FROM predictions JOIN transactions USING (tx_uuid) GROUP BY 1),
b AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT CAST(round(CAST(sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS DECIMAL(38,10)), 6) AS DOUBLE) AS auc,
  CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM b"""))
def eval_auc(spark, sf_dir):
    """M6: ROC-AUC of all stored scores, exact."""
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    scored = X.predictions(t, tx).join(tx.select("tx_uuid", "is_fraud"), "tx_uuid")
    return auc_by_group(scored, [], "fraud_probability", "is_fraud").select(round_half_up("auc", 6).alias("auc"), "positives", "negatives")


def _onehot_sql() -> str:
    blocks = ", ".join(f"dense_rank() OVER (ORDER BY {c}) AS {c}_at" for c in FRAUD_CATEGORICAL)
    return f"SELECT tx_uuid, {blocks}, (SELECT {' + '.join(f'count(DISTINCT {c})' for c in FRAUD_CATEGORICAL)} FROM transactions) + {len(FRAUD_NUMERIC)} AS n_features FROM transactions"


@register("onehot_features", fraud(_onehot_sql()))
def onehot_features(spark, sf_dir):
    """M1/M2: where each category's one stands in its block of the assembled vector, and the vector's length."""
    _, _, feats = _fraud_feats(spark, sf_dir)
    stages = build_pipeline(FRAUD_CATEGORICAL, FRAUD_NUMERIC, "is_fraud").getStages()[:-1]
    model = Pipeline(stages=stages).fit(feats)
    vector = vector_to_array("features")
    out = model.transform(feats).withColumn("_v", vector)
    start, columns = 0, []
    for c, labels in zip(FRAUD_CATEGORICAL, model.stages[0].labelsArray, strict=True):
        columns.append(F.array_position(F.slice("_v", start + 1, len(labels)), F.lit(1.0)).alias(f"{c}_at"))
        start += len(labels)
    return out.select("tx_uuid", *columns, F.size("_v").cast("long").alias("n_features"))


_registries: dict[tuple, str] = {}


def _registry(spark, t: Tables) -> str:
    """The session's model registry for a set of input files."""
    key = (spark.sparkContext.applicationId, *t.events.inputFiles(), *t.customer.inputFiles())
    return _registries.setdefault(key, shared_dir(spark, "registry"))


def _trained(spark, sf_dir) -> TrainResult:
    """A model of the whole feature set, registered as challenger and judged by the gate."""
    t, _, feats = _fraud_feats(spark, sf_dir)
    root, result = _registry(spark, t), train_fraud(feats)
    version = registry.register_model(spark, root, "fraud", result, "roc_auc", feats.schema)
    registry.set_alias(spark, root, "fraud", registry.CHALLENGER, version)
    registry.promote(spark, root, "fraud")
    return result


@register("train_fraud_model")
def train_fraud_model(spark, sf_dir):
    """M3/M4/M6: train on the whole feature set and register the model; one row of run metrics."""
    m = _trained(spark, sf_dir).metrics
    return spark.createDataFrame([(m["n_train"], m["n_test"], m["roc_auc"])],
                                 "n_train long, n_test long, roc_auc double")


@register("score_backlog")
def score_backlog(spark, sf_dir):
    """The champion scores every transaction that has no prediction yet; the rows that the job wrote.

    A model is trained only where the registry has no champion.
    """
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    models = ModelCache(alias_lookup(spark, _registry(spark, t), "fraud"))
    if models.current() is None:
        _trained(spark, sf_dir)
    path = os.path.join(shared_dir(spark, "predictions"), "table")
    write_predictions(X.predictions(t, tx), path, 0, "stored")
    drain_backlog(spark, tx, models, path, "backlog")
    rows = spark.read.parquet(path).filter("writer = 'backlog'").drop("writer", "batch_id")
    return rows.join(tx.select("tx_uuid", "created_at"), "tx_uuid")


@register("backlog_checks", fraud("""
SELECT count(*) FILTER (id % 10 = 0) AS scored_now, count(*) AS predictions, 0::BIGINT AS repeated, 0::BIGINT AS unscored,
  0::BIGINT AS out_of_range, 0::BIGINT AS wrong_label FROM transactions"""))
def backlog_checks(spark, sf_dir):
    """After the job every transaction has one prediction, a probability, with its label at one half."""
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    now = score_backlog(spark, sf_dir)
    every = X.predictions(t, tx).select("tx_uuid", "fraud_probability", "pred_label", F.lit(False).alias("now")).unionByName(
        now.select("tx_uuid", "fraud_probability", "pred_label", F.lit(True).alias("now")))
    p = F.col("fraud_probability")
    left = tx.join(every, "tx_uuid", "left_anti").agg(F.count(F.lit(1))).scalar()
    return every.agg(F.count_if("now").alias("scored_now"), F.count(F.lit(1)).alias("predictions"),
                     (F.count(F.lit(1)) - F.countDistinct("tx_uuid")).alias("repeated"), F.max(left).alias("unscored"),
                     F.count_if(p.isNull() | ~p.between(0, 1)).alias("out_of_range"), F.count_if(F.col("pred_label") != decision(p)).alias("wrong_label"))


@register("train_congestion_model")
def train_congestion_model(spark, sf_dir):
    """M5/M7: 3-class forest on the congestion features; one row of run metrics."""
    pos = X.vehicle_positions(Tables(spark, sf_dir))
    feats = pos.select("pos_uuid", "road_type", "maxspeed", "sim_hour", "sim_dow",
                       congestion_level(F.col("speed_kmh")).alias("congestion"))
    m = train_congestion(feats, key="pos_uuid").metrics
    return spark.createDataFrame([(m["n_train"], m["n_test"], float(m["accuracy"]))],
                                 "n_train long, n_test long, accuracy double")
