"""Stream scoring end to end: both models, a swap mid-stream with its run log, repair, restart; and what stops a retrain."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakehound.functions.scalar import congestion_level
from lakehound.plans import registry as R
from lakehound.plans import retrain as retrain_module
from lakehound.plans.features import fraud_features
from lakehound.plans.retrain import StepFailed, retrain
from lakehound.plans.training import predict_table, stratified_split, train_congestion, train_fraud
from lakehound.schemas import FRAUD_EVENT_FULL, ROAD_EVENT
from lakehound.sources import fixtures as X
from lakehound.sources.tables import Tables
from lakehound.streaming.changes import (FRAUD_REQUEST_RULES, ROAD_REQUEST_RULES, parse_change, read_change_stream, validate,
                                         with_event_time)
from lakehound.streaming.replay import files_per_batch, finished, stopped_and_resumed, write_in_order
from lakehound.streaming.scorer import RAW, ModelCache, alias_lookup, drain_backlog, run_logger, score_stream, start
from lakehound.streaming.windows import minute_counts_stream

FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def models(spark, tables):
    pos = X.vehicle_positions(tables)
    road = pos.select("pos_uuid", "road_type", "maxspeed", "sim_hour", "sim_dow", congestion_level(F.col("speed_kmh")).alias("congestion"))
    return {"fraud": train_fraud(fraud_features(X.transactions(tables)), n_trees=2, max_depth=3),
            "congestion": train_congestion(road, n_trees=2, max_depth=3, key="pos_uuid")}


def _json(rows):
    return [r.value for r in rows.select(F.to_json(F.struct(*rows.columns), FORMAT).alias("value")).collect()]


def _file(folder, k, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{k}.json"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + 100 * k,) * 2)


def _stream(spark, folder, schema, raw=None):
    return with_event_time(parse_change(read_change_stream(spark, {"kind": "files", "path": folder, "max_files": 1}), schema, raw=raw))


def _register(spark, root, name, result, metric):
    version = R.register_model(spark, root, name, result, metric)
    R.set_alias(spark, root, name, R.CHAMPION, version)
    return version


def test_congestion_stream_swap_quarantine_and_restart(spark, scratch, tables, models):
    """Three batches: no model, version 1, version 2; broken rows in quarantine; each version's run logged once."""
    pos = X.vehicle_positions(tables).orderBy("pos_uuid")
    lines = _json(pos.limit(90))
    broken = [json.dumps(json.loads(lines[0]) | {"pos_uuid": "bad", "speed_kmh": -1}), json.dumps(json.loads(lines[0]) | {"pos_uuid": None}), "{not json"]
    root, log, folder = f"{scratch}/registry", f"{scratch}/runs", f"{scratch}/in"
    cache = ModelCache(alias_lookup(spark, root, "congestion"), run_logger(spark, root, "congestion", log))

    def run():
        finished(score_stream(_stream(spark, folder, ROAD_EVENT, RAW), cache, f"{scratch}/out", f"{scratch}/ck", kind="congestion",
                              quarantine=f"{scratch}/bad", available_now=True))

    _file(folder, 0, lines[:30] + broken)
    run()
    assert not os.path.exists(f"{scratch}/out")  # no champion: skipped (T6)
    _register(spark, root, "congestion", models["congestion"], "accuracy")
    _file(folder, 1, lines[30:60])
    run()
    _register(spark, root, "congestion", models["congestion"], "accuracy")
    _file(folder, 2, lines[60:])
    run()
    got = spark.read.parquet(f"{scratch}/out")
    by = {r.model_version: r.n for r in got.groupBy("model_version").agg(F.countDistinct("pos_uuid").alias("n")).collect()}
    assert by == {"1": 30, "2": 30} and got.count() == 60
    want = {r.pos_uuid: r.level for r in pos.limit(90).select("pos_uuid", congestion_level(F.col("speed_kmh")).alias("level")).collect()}
    for r in got.collect():  # all columns of the sink, the actual level beside the predicted one (M9, S10)
        assert r.actual_congestion == want[r.pos_uuid] and r.pred_congestion in (0, 1, 2) and 0 < r.pred_proba <= 1 and r.event_time
    bad = spark.read.parquet(f"{scratch}/bad").collect()
    reasons = {r.pos_uuid: set(r.reasons) for r in bad}
    assert reasons["bad"] == {"speed_nonneg"} and "has_key" in reasons[None]
    assert any(r._raw == "{not json" for r in bad)
    runs = R.run_log(spark, log, spark.createDataFrame([], "model_version string, metric double, n_train long").schema)
    assert sorted((r.model_version, r.metric, r.n_train) for r in runs.collect()) == [
        (v, models["congestion"].metrics["accuracy"], models["congestion"].metrics["n_train"]) for v in ("1", "2")]
    # a second scorer that starts afresh logs no version again
    again = ModelCache(alias_lookup(spark, root, "congestion"), run_logger(spark, root, "congestion", log))
    assert again.current()[0] == "2" and runs.count() == 2


def test_swap_in_the_middle_of_one_run(spark, scratch, tables, models):
    """The champion moves while a query runs: every batch is scored by one version."""
    lines = _json(X.transactions(tables).orderBy("id").limit(60))
    root = f"{scratch}/registry"
    _register(spark, root, "fraud", models["fraud"], "roc_auc")
    for k in range(3):
        _file(f"{scratch}/in", k, lines[20 * k:20 * k + 20])
    served, lookup = [], alias_lookup(spark, root, "fraud")

    def counting():
        served.append(None)
        if len(served) == 2:
            _register(spark, root, "fraud", models["fraud"], "roc_auc")
        if len(served) == 3:
            raise OSError("registry away")  # goes on with what it served
        return lookup()

    finished(score_stream(_stream(spark, f"{scratch}/in", FRAUD_EVENT_FULL), ModelCache(counting, run_logger(spark, root, "fraud", f"{scratch}/runs")),
                          f"{scratch}/out", f"{scratch}/ck", available_now=True))
    got = spark.read.parquet(f"{scratch}/out").groupBy("batch_id").agg(F.collect_set("model_version").alias("v"), F.count(F.lit(1)).alias("n"))
    assert {r.batch_id: (r.v, r.n) for r in got.collect()} == {0: (["1"], 20), 1: (["2"], 20), 2: (["2"], 20)}
    assert spark.read.parquet(f"{scratch}/runs").count() == 2


def test_model_cache_keeps_two_versions_and_logs_before_serving(models, scratch):
    from lakehound.plans.training import save_model
    path, now, logged = save_model(models["fraud"].model, f"{scratch}/m"), ["a"], []

    def on_load(version):
        if version == "b" and logged.count("b") < 1:
            logged.append(version)
            raise OSError("log away")
        logged.append(version)

    cache = ModelCache(lambda: (now[0], path), on_load)
    first = cache.current()[1]
    now[0] = "b"
    with pytest.raises(OSError):
        cache.current()
    assert cache.current()[0] == "b"  # tried again, not served unlogged
    now[0] = "a"
    assert cache.current()[1] is first and logged == ["a", "b", "b"]  # a rollback needs no load
    now[0] = "c"
    cache.current()
    assert set(cache._loaded) == {"a", "c"}
    assert ModelCache(lambda: None).current() is None


def test_skipped_batches_are_repaired(spark, scratch, tables, models):
    """T6 then T7: what came before the first model is scored by the backlog job, once."""
    tx = X.transactions(tables)
    lines = _json(tx.orderBy("id").limit(40))
    root, out = f"{scratch}/registry", f"{scratch}/out"
    cache = ModelCache(alias_lookup(spark, root, "fraud"))
    for k in range(2):
        if k:
            _register(spark, root, "fraud", models["fraud"], "roc_auc")
        _file(f"{scratch}/in", k, lines[20 * k:20 * k + 20])
        finished(score_stream(_stream(spark, f"{scratch}/in", FRAUD_EVENT_FULL), cache, out, f"{scratch}/ck", available_now=True))
    assert spark.read.parquet(out).count() == 20
    for _ in range(2):
        assert drain_backlog(spark, tx.orderBy("id").limit(40), cache, out)
    assert spark.read.parquet(out).count() == spark.read.parquet(out).select("tx_uuid").distinct().count() == 40
    with pytest.raises(Exception, match="no model available"):
        q = score_stream(_stream(spark, f"{scratch}/in", FRAUD_EVENT_FULL), ModelCache(lambda: None), out, f"{scratch}/ck2", on_missing="raise", available_now=True)
        q.awaitTermination()


def test_stateful_stream_stopped_between_batches(spark, scratch, tables):
    tx = X.transactions(tables)
    events = tx.select(F.to_json(F.struct(*tx.columns), FORMAT).alias("value"), "created_at")
    write_in_order(events, f"{scratch}/in", '{"tx_uuid": "end", "source": "end", "created_at": "%s"}')
    files = [f for f in os.listdir(f"{scratch}/in") if f.endswith(".txt")]
    assert len(files) == 2 * files_per_batch(spark) + 1
    source = {"kind": "files", "path": f"{scratch}/in", "max_files": files_per_batch(spark)}
    rows = with_event_time(parse_change(read_change_stream(spark, source), FRAUD_EVENT_FULL))
    stopped_and_resumed(lambda **how: start(minute_counts_stream(rows), f"{scratch}/ck", path=f"{scratch}/out", **how))
    got = spark.read.parquet(f"{scratch}/out").filter("source <> 'end'")
    want = tx.groupBy(F.date_trunc("minute", "created_at").cast("timestamp").alias("time"), "source").agg(F.count(F.lit(1)).alias("events"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_replay_of_one_time_and_of_nothing(spark, scratch):
    one = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("value"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"))
    write_in_order(one, f"{scratch}/one", "end %s")
    sizes = spark.read.text(f"{scratch}/one").filter("value <> ''").groupBy("_metadata.file_path").count().filter("count > 1").collect()
    assert sum(r["count"] for r in sizes) == 5000 and max(r["count"] for r in sizes) < 2 * 5000 / len(sizes)
    write_in_order(one.limit(0), f"{scratch}/none", "end %s")
    assert not os.path.exists(f"{scratch}/none")


def test_request_rules_need_their_columns(spark):
    row = ("t1", 1, 5.0, "food", "JP", "web", 1.0, 2.0, "c", None, "2024-01-01 00:00:00")
    names = ["tx_uuid", "user_id", "amount", "merchant_category", "country", "device", "latitude", "longitude", "source", "is_fraud", "created_at"]
    schema = ", ".join(f"{n} {'double' if n in ('amount', 'latitude', 'longitude') else 'int' if n in ('user_id', 'is_fraud') else 'string'}" for n in names)
    rows = [row] + [tuple(None if j == i else v for j, v in enumerate(row)) for i in range(len(row))]
    good, bad = validate(spark.createDataFrame(rows, schema), FRAUD_REQUEST_RULES)
    assert good.count() == 2  # the whole row, and the one without the label, which has a default
    assert all(len(r.reasons) == 1 for r in bad.collect()) and bad.count() == len(row) - 1
    assert {"has_vehicle_id", "has_link_id", "has_road_type"} <= set(ROAD_REQUEST_RULES)


def test_predictions_of_broken_requests_are_null(spark, models):
    rows = spark.createDataFrame([(5.0, "click", "JP", "web", 3, 2), (-5.0, "click", "JP", "web", 3, 2), (5.0, "click", "JP", "web", 24, 8), (None, "click", "JP", "web", 1, 1)],
                                 "amount double, merchant_category string, country string, device string, hour int, dow int")
    got = predict_table(models["fraud"].model, rows).collect()
    assert [r.reasons for r in got] == [[], ["amount_positive"], ["hour_range", "dow_range"], ["amount_positive"]]
    assert got[0].is_fraud in (0, 1) and all(r.fraud_probability is None and r.is_fraud is None for r in got[1:])


@pytest.mark.parametrize("step", ["features", "train", "promote"])
def test_retrain_stops_at_the_failing_step(spark, scratch, tables, monkeypatch, step):
    def fail(*_a, **_k):
        raise ValueError("broken")

    monkeypatch.setattr(*{"features": (retrain_module, "write_features", fail), "train": (retrain_module, "train_fraud", fail),
                          "promote": (R, "promote", fail)}[step])
    done = []
    for name in ("register_model", "promote"):
        own = getattr(R, name)
        monkeypatch.setattr(R, name, lambda *a, _own=own, _n=name, **k: (done.append(_n), _own(*a, **k))[1])
    with pytest.raises(StepFailed, match=f"{step}: broken"):
        retrain(spark, X.transactions(tables), scratch, n_trees=2, max_depth=2)
    assert done == {"features": [], "train": [], "promote": ["register_model", "promote"]}[step]
    assert R.metric_for_alias(spark, scratch, "fraud", R.CHAMPION).count() == 0


def test_split_is_exact_with_and_without_a_key(spark):
    rows = spark.range(997).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 97 == 1, None).otherwise(0).alias("y"))
    for key in ("k", None):
        train, test = stratified_split(rows.persist(), "y", key)
        sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
        tested = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
        assert sum(tested.values()) == 200 and all(0 <= n - int(0.2 * sizes[y]) <= 1 for y, n in tested.items())
        assert train.count() + test.count() == 997 and train.join(test, "k").count() == 0
    one, rest = stratified_split(rows.filter("y = 1"), "y", "k")
    assert rest.count() == 20 and one.count() == 80
