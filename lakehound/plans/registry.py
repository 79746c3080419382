"""Model registry as three append-only logs.

``{root}/model_versions``: seq, id, name, run_id, model_path, created_at, params, input_schema
``{root}/model_runs``:     run_id, name, trained_at, n_train, n_test, metric_name, metric
``{root}/model_aliases``:  seq, id, name, alias, run_id, set_at

Versions are numbered when they are read, by the total order of the log (seq, id): two registrations
at once get two numbers. Aliases name a run, not a number, and the last entry of the log holds, so
neither clocks nor a late entry move them. Setting an alias is an append, a rollback another one.
These tables hold one row per training run: the control plane, not data.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.operators.dedup import latest_by_key
from lakehound.plans.training import TrainResult, save_model
from lakehound.sources.versions import ORDER, append_entry, read_log, read_or_empty, write_entry

VERSIONS_SCHEMA = T.StructType([
    *ORDER, T.StructField("name", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("model_path", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("params", T.StringType()), T.StructField("input_schema", T.StringType())])
RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("trained_at", T.TimestampType()), T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()), T.StructField("metric_name", T.StringType()),
    T.StructField("metric", T.DoubleType())])
ALIASES_SCHEMA = T.StructType([
    *ORDER, T.StructField("name", T.StringType()), T.StructField("alias", T.StringType()),
    T.StructField("run_id", T.StringType()), T.StructField("set_at", T.TimestampType())])

CHAMPION, CHALLENGER = "champion", "challenger"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _at(root: str, name: str) -> str:
    return os.path.join(root, name)


def numbered(log: DataFrame) -> DataFrame:
    """Add ``version``, 1 for a model's first entry in the log; one model's entries are few."""
    place = Window.partitionBy("name").orderBy("seq", "id")
    return log.withColumn("version", F.row_number().over(place))


def versions(spark: SparkSession, root: str) -> DataFrame:
    return numbered(read_log(spark, _at(root, "model_versions"), VERSIONS_SCHEMA))


def runs(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, _at(root, "model_runs"), RUNS_SCHEMA)


def alias_log(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, _at(root, "model_aliases"), ALIASES_SCHEMA)


def newest_version(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> int:
    """Largest version number of a model (optionally of one run); 0 if none."""
    v = versions(spark, root).filter(F.col("name") == name)
    if run_id is not None:
        v = v.filter(F.col("run_id") == run_id)
    return int(v.agg(F.max("version")).first()[0] or 0)


def register_model(spark: SparkSession, root: str, name: str, result: TrainResult,
                   metric_name: str, input_schema: T.StructType | None = None) -> int:
    """Save the model, log the run and add a version; returns its number."""
    run_id = uuid.uuid4().hex
    # the path is the run's own, so two registrations at once never share an artifact
    path = save_model(result.model, os.path.join(root, "artifacts", name, run_id))
    now = _now()
    m = result.metrics
    metric = m.get(metric_name)
    run = (run_id, name, now, int(m.get("n_train") or 0), int(m.get("n_test") or 0), metric_name,
           None if metric is None else float(metric))
    write_entry(spark.createDataFrame([run], RUNS_SCHEMA), _at(root, "model_runs"))
    append_entry(spark, _at(root, "model_versions"), VERSIONS_SCHEMA, name=name, run_id=run_id, model_path=path, created_at=now,
                 params=json.dumps(result.params, sort_keys=True), input_schema=input_schema.json() if input_schema is not None else None)
    return newest_version(spark, root, name, run_id)


def set_alias(spark: SparkSession, root: str, name: str, alias: str, version: int) -> None:
    """Point ``alias`` at the run that has this version number now (also how a rollback is done)."""
    row = versions(spark, root).filter((F.col("name") == name) & (F.col("version") == int(version))).first()
    if row is None:
        raise ValueError(f"{name} has no version {version}")
    append_entry(spark, _at(root, "model_aliases"), ALIASES_SCHEMA, name=name, alias=alias, run_id=row.run_id, set_at=_now())


def newest_aliases(log: DataFrame) -> DataFrame:
    """The entry in force of each (name, alias): the last one of the log."""
    return latest_by_key(log, ["name", "alias"], [F.col("seq").desc(), F.col("id").desc()])


def aliases(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current alias -> run and version."""
    now = newest_aliases(alias_log(spark, root).filter(F.col("name") == name))
    return now.join(versions(spark, root).select("run_id", "version", "model_path", "created_at"), "run_id", "left")


def metric_for_alias(spark: SparkSession, root: str, name: str, alias: str) -> DataFrame:
    """Alias -> version -> run metric; 0 rows without the alias, NULL metric without a run."""
    a = aliases(spark, root, name).filter(F.col("alias") == alias).select("run_id", "name", "version", "model_path")
    return a.join(runs(spark, root).select("run_id", "metric"), "run_id", "left")


#: The metric of a run without one (X10): below every real metric.
NO_METRIC = -1.0


def gate(candidates: DataFrame, promote_on_tie: bool = True) -> DataFrame:
    """The gate's verdict for rows of (challenger, challenger_metric, champion, champion_metric).

    Adds ``decision`` (stop, keep or promote) and ``reason``; versions are NULL where an alias is unset.
    """
    new, old = (F.coalesce(F.col(f"{side}_metric"), F.lit(NO_METRIC)) for side in (CHALLENGER, CHAMPION))
    case = (F.when(F.col(CHALLENGER).isNull(), "stop: nothing to judge")
            .when(F.col(CHAMPION).isNull(), "promote: first of its name")
            .when(F.col(CHAMPION) == F.col(CHALLENGER), "keep: both aliases name one version")
            .when(new > old, "promote: higher metric")
            .when(new < old, "keep: lower metric")
            .otherwise("promote: equal metric" if promote_on_tie else "keep: equal metric"))
    parts = F.split(case, ": ")
    return candidates.withColumn("decision", parts[0]).withColumn("reason", parts[1])


def promote(spark: SparkSession, root: str, name: str, promote_on_tie: bool = True) -> dict:
    """Judge the challenger of ``name`` against its champion and, if it wins, move the champion alias."""
    sides = [metric_for_alias(spark, root, name, alias).select(
        F.col("version").alias(alias), F.col("metric").alias(f"{alias}_metric"), F.lit(name).alias("name"))
        for alias in (CHALLENGER, CHAMPION)]
    one = spark.createDataFrame([(name,)], "name string")
    verdict = gate(one.join(sides[0], "name", "left").join(sides[1], "name", "left"), promote_on_tie).first().asDict()
    if verdict["decision"] == "promote":
        set_alias(spark, root, name, CHAMPION, verdict[CHALLENGER])
    return verdict


def view(current: DataFrame, runs: DataFrame) -> DataFrame:
    """Version, metric and creation time of each alias, from aliases with their versions and runs."""
    return (current.join(runs.select("run_id", "metric_name", "metric"), "run_id", "left")
            .select("alias", "version", "metric_name", "metric", "created_at").orderBy("alias"))


def registry_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Alias, version, metric and creation time of each aliased version."""
    return view(aliases(spark, root, name), runs(spark, root))


def replay(trained: DataFrame, promote_on_tie: bool = True) -> DataFrame:
    """J8/M12 over a history: ``trained`` (version, metric), each version a challenger in turn of version.

    The champion before a row is the best of all earlier versions, of equal ones the last (or the
    first, where a tie does not win). Adds challenger, champion, their metrics, and the gate's verdict.
    One row a training run: a single ordered window.
    """
    metric = F.coalesce("metric", F.lit(NO_METRIC))
    best = F.struct(metric.alias("m"), (F.col("version") if promote_on_tie else -F.col("version")).alias("v"),
                    F.col("version").alias("version"), F.col("metric").alias("metric"))
    before = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    rows = trained.withColumn("_best", F.max(best).over(before)).select(
        *trained.columns, F.col("version").alias(CHALLENGER), F.col("metric").alias(f"{CHALLENGER}_metric"),
        F.col("_best.version").alias(CHAMPION), F.col("_best.metric").alias(f"{CHAMPION}_metric"))
    return gate(rows, promote_on_tie)


def alias_entries(verdicts: DataFrame, name: str) -> DataFrame:
    """The alias log that a replay leaves: the challenger of every run, and the champion where one is promoted."""
    sides = [verdicts.select((F.col("version") * 2).alias("seq"), F.lit(CHALLENGER).alias("alias"), "version"),
             verdicts.filter(F.col("decision") == "promote").select((F.col("version") * 2 + 1).alias("seq"), F.lit(CHAMPION).alias("alias"), "version")]
    return sides[0].unionByName(sides[1]).select("seq", F.lit("").alias("id"), F.lit(name).alias("name"), "alias", "version")


def rolled_back(verdicts: DataFrame, log: DataFrame) -> DataFrame:
    """``log`` with one entry more, that sets the champion back to the one before the last promotion."""
    last = verdicts.filter((F.col("decision") == "promote") & F.col(CHAMPION).isNotNull())
    back = last.agg(F.max_by(CHAMPION, "version").alias("version"), F.max_by("name", "version").alias("name"))
    end = log.agg(F.max("seq")).scalar()
    entry = back.filter(F.col("version").isNotNull()).select(
        (end + 1).alias("seq"), F.lit("").alias("id"), "name", F.lit(CHAMPION).alias("alias"), "version")
    return log.unionByName(entry)


def model_history(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Metric by training time."""
    return (runs(spark, root).filter(F.col("name") == name)
            .select(F.col("trained_at").alias("time"), "metric").orderBy("time"))


def log_model_run(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Log runs (model_version, ...) whose version is not logged yet; returns how many.

    A version's run is a partition of its own that is written whole, so a repeated or concurrent call
    leaves one copy.
    """
    have = read_or_empty(spark, path, T.StructType([T.StructField("model_version", T.StringType())]))
    new = rows.join(have, "model_version", "left_anti").dropDuplicates(["model_version"]).persist()
    n = new.count()
    if n:
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_version").parquet(path)
    new.unpersist()
    return n


def run_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The logged runs."""
    return read_or_empty(spark, path, schema)
