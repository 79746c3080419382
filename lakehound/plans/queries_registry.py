"""Registered queries of the model registry: the daily runs replayed as registrations."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehound.plans import registry as R
from lakehound.plans.catalog import register
from lakehound.plans.oracle import fraud
from lakehound.plans.queries_ml import _RUNS_SQL, _runs
from lakehound.session import shared_dir

NAME = "fraud"

_LOG_SQL = _RUNS_SQL + """,
versions AS (SELECT row_number() OVER (ORDER BY trained_at) AS version, * FROM model_runs),
paired AS (SELECT c.version, c.model_version, c.metric,
    (SELECT p.version FROM versions p WHERE p.version < c.version ORDER BY coalesce(p.metric, -1) DESC, p.version DESC LIMIT 1) AS champion
  FROM versions c),
log AS (SELECT a.*, b.metric AS champion_metric,
    CASE WHEN champion IS NULL OR coalesce(a.metric, -1) >= coalesce(b.metric, -1) THEN 'promote' ELSE 'keep' END AS decision,
    CASE WHEN champion IS NULL THEN 'first of its name' WHEN coalesce(a.metric, -1) > coalesce(b.metric, -1) THEN 'higher metric'
      WHEN coalesce(a.metric, -1) < coalesce(b.metric, -1) THEN 'lower metric' ELSE 'equal metric' END AS reason
  FROM paired a LEFT JOIN versions b ON b.version = a.champion),
champions AS (SELECT max(version) FILTER (decision = 'promote') AS now,
  max_by(champion, version) FILTER (decision = 'promote' AND champion IS NOT NULL) AS back FROM log)
"""


def _replayed(spark, sf_dir):
    """The daily evaluation runs as versions of one model, and the gate's verdict on each."""
    place = F.row_number().over(Window.orderBy("trained_at"))  # one row a day
    return R.replay(_runs(spark, sf_dir).withColumn("version", place)).withColumn("name", F.lit(NAME))


@register("promotion_log", fraud(_LOG_SQL + """
SELECT model_version, version AS challenger, metric AS challenger_metric, champion, champion_metric, decision, reason FROM log"""))
def promotion_log(spark, sf_dir):
    """The gate's verdict on every run in turn."""
    return _replayed(spark, sf_dir).select("model_version", "challenger", "challenger_metric", "champion", "champion_metric", "decision", "reason")


def _current(spark, sf_dir, back: bool = False):
    verdicts = _replayed(spark, sf_dir)
    log = R.alias_entries(verdicts, NAME)
    return verdicts, R.newest_aliases(R.rolled_back(verdicts, log) if back else log)


@register("alias_current", fraud(_LOG_SQL + """
SELECT 'challenger' AS alias, max(version) AS version FROM log UNION ALL SELECT 'champion', now FROM champions"""))
def alias_current(spark, sf_dir):
    """The aliases in force after all runs."""
    return _current(spark, sf_dir)[1].select("alias", "version")


@register("registry_view", fraud(_LOG_SQL + """
SELECT a.alias, v.version, 'roc_auc' AS metric_name, v.metric, v.trained_at AS created_at
FROM (SELECT 'challenger' AS alias, max(version) AS version FROM log UNION ALL SELECT 'champion', now FROM champions) a
JOIN versions v ON v.version = a.version"""))
def registry_view(spark, sf_dir):
    """Version, metric and time of each alias."""
    verdicts, now = _current(spark, sf_dir)
    of = verdicts.select("version", F.col("model_version").alias("run_id"), F.col("trained_at").alias("created_at"))
    done = verdicts.select(F.col("model_version").alias("run_id"), F.lit("roc_auc").alias("metric_name"), "metric")
    return R.view(now.join(of, "version"), done)


@register("rollback", fraud(_LOG_SQL + """
SELECT 'challenger' AS alias, max(version) AS version FROM log UNION ALL SELECT 'champion', coalesce(back, now) FROM champions"""))
def rollback(spark, sf_dir):
    """The aliases after the champion was set back by one."""
    return _current(spark, sf_dir, back=True)[1].select("alias", "version")


@register("model_run_log", fraud(_RUNS_SQL + "SELECT * FROM model_runs"))
def model_run_log(spark, sf_dir):
    """All runs logged twice, each stays once."""
    done = _runs(spark, sf_dir).persist()
    path = os.path.join(shared_dir(spark, "runs"), "log")
    R.log_model_run(spark, path, done.filter(F.dayofmonth("trained_at") % 2 == 0))
    for _ in range(2):  # the days logged above, and all of them again, add nothing
        R.log_model_run(spark, path, done)
    return R.run_log(spark, path, done.schema).select(*done.columns)
