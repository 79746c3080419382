"""Logs with a total order, published tables, the merged snapshot, idempotent appends and the registry's numbers."""

import datetime as dt
import random
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lakehound.operators.dedup import latest_by_key
from lakehound.plans import registry as R
from lakehound.plans.training import TrainResult
from lakehound.sources import sinks
from lakehound.sources.snapshots import snapshot
from lakehound.sources.versions import POINTER, append_entry, current_path, newest, read_log, write_entry

ROW = "k string, v long, at timestamp, note string"


def _rows(n, seed, days=70):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 15)
    return [(f"k{rnd.randrange(n // 2)}", rnd.randrange(1000), start + dt.timedelta(days=rnd.randrange(days)) if rnd.random() < 0.95 else None,
             f"{seed}-{i}") for i in range(n)]




def _order():
    return [F.col("v").desc(), F.col("note").desc()]


def test_snapshot_equals_full_dedup_after_every_fold(spark, scratch):
    like = spark.createDataFrame([], ROW)
    snap = snapshot(spark, scratch, like, ["k"], _order(), "at")
    assert snap.fold() is None and snap.read().count() == 0 and snap.as_of() is None
    seen = []
    for seed, n in ((1, 400), (2, 30), (3, 5), (4, 200)):
        rows = _rows(n, seed)
        seen += rows
        snap.append(spark.createDataFrame(rows, ROW))
        assert snap.fold()
        want = sorted((tuple(r) for r in latest_by_key(spark.createDataFrame(seen, ROW), ["k"], _order()).collect()), key=str)
        assert sorted((tuple(r) for r in snap.read().collect()), key=str) == want
        assert snap.as_of() == max(r[2] for r in want if r[2])
    assert snap.fold() is None  # nothing new


def test_snapshot_writes_only_the_ranges_that_change(spark, scratch):
    snap = snapshot(spark, scratch, spark.createDataFrame([], ROW), ["k"], _order(), "at")
    snap.append(spark.createDataFrame([(f"k{i}", 1, dt.datetime(2024, 1 + i % 6, 3), "a") for i in range(60)], ROW))
    snap.fold()
    before = {r.range: r.gen for r in snap._manifest()[0].collect()}
    # k0 moves from January to March, k1 (February) loses against its stored row
    snap.append(spark.createDataFrame([("k0", 2, dt.datetime(2024, 3, 9), "b"), ("k1", 0, dt.datetime(2024, 5, 9), "b")], ROW))
    snap.fold()
    after = {r.range: r.gen for r in snap._manifest()[0].collect()}
    assert {x for x in after if after[x] != before[x]} == {"2024-01", "2024-02", "2024-03"}
    plan = snap.read(dt.datetime(2024, 5, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in plan and "(range" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.at.month for r in snap.read(dt.datetime(2024, 5, 1)).collect()} == {5, 6}


def test_snapshot_batch_sent_twice_and_folds_at_once(spark, scratch):
    snap = snapshot(spark, scratch, spark.createDataFrame([], ROW), ["k"], _order(), "at")
    rows = spark.createDataFrame(_rows(40, 7), ROW)
    assert snap.append(rows, "b1") == snap.append(rows, "b1") == "b1"
    snap.fold()
    snap.append(spark.createDataFrame(_rows(10, 8), ROW), "b2")
    base = snap._manifest()  # both folds begin from this manifest
    other = snapshot(spark, scratch, rows, ["k"], _order(), "at")
    object.__setattr__(other, "_manifest", lambda: base)
    snap.fold()
    snap.append(spark.createDataFrame(_rows(10, 9), ROW), "b3")
    other.fold()  # holds b2 and b3
    while snap.fold():
        pass
    every = spark.createDataFrame(_rows(40, 7) + _rows(10, 8) + _rows(10, 9), ROW)
    assert sorted(map(str, snap.read().collect())) == sorted(map(str, latest_by_key(every, ["k"], _order()).collect()))


def test_reader_finishes_on_the_rows_it_began_with(spark, scratch):
    with pytest.raises(FileNotFoundError):
        sinks.read_dimension(spark, scratch)
    sinks.refresh_dimension(spark.range(5).withColumn("x", F.lit("old")), scratch)
    reader = sinks.read_dimension(spark, scratch)
    sinks.refresh_dimension(spark.range(3).withColumn("x", F.lit("new")), scratch)
    assert {r.x for r in reader.collect()} == {"old"} and reader.count() == 5
    assert {r.x for r in sinks.read_dimension(spark, scratch).collect()} == {"new"}
    # a refresh from the table itself
    sinks.refresh_dimension(sinks.read_dimension(spark, scratch).filter("id > 0"), scratch)
    assert sinks.read_dimension(spark, scratch).count() == 2


def test_a_failed_refresh_changes_nothing(spark, scratch):
    sinks.refresh_dimension(spark.range(5), scratch)
    was = current_path(spark, scratch)
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.refresh_dimension(bad, scratch)
    assert current_path(spark, scratch) == was and sinks.read_dimension(spark, scratch).count() == 5


def test_log_order_does_not_follow_clocks_or_late_entries(spark, scratch):
    for path in ("a", "b", "c"):
        append_entry(spark, scratch, POINTER, path=path)
    # a second writer that saw only two entries
    write_entry(spark.createDataFrame([(3, "00", "late")], POINTER), scratch)
    log = read_log(spark, scratch, POINTER)
    assert [r.path for r in log.orderBy("seq", "id").collect()] == ["a", "b", "late", "c"]
    assert log.agg(newest("path")).first()[0] == "c"


def test_batch_sent_twice_leaves_one_copy(spark, scratch):
    rows = spark.createDataFrame([(f"t{i}", float(i)) for i in range(30)] + [(None, 1.0), (None, 2.0)], "tx_uuid string, amount double")
    assert sinks.append_rows(rows, scratch, stable_from=["amount"]) == 32
    assert sinks.append_rows(rows, scratch, stable_from=["amount"]) == 0
    more = spark.createDataFrame([("t3", 9.0), ("new", 1.0), ("new", 2.0)], "tx_uuid string, amount double")
    assert sinks.append_rows(more, scratch) == 1
    got = spark.read.parquet(scratch)
    assert got.count() == got.select("tx_uuid").distinct().count() == 33
    assert {r.amount for r in got.filter("tx_uuid in ('t3', 'new')").collect()} == {3.0, 1.0}


def test_a_request_has_1_to_5000_rows(spark, scratch):
    rows = spark.range(5001).select(F.col("id").cast("string").alias("tx_uuid"))
    for bad in (rows, rows.limit(0)):
        with pytest.raises(ValueError, match="1 to 5000"):
            sinks.append_request(bad, scratch)
    assert sinks.append_request(rows.limit(5000), scratch) == 5000


def _fake(metric):
    return TrainResult(PipelineModel(stages=[]), {"n_train": 1, "n_test": 1, "roc_auc": metric}, {})


def test_two_registrations_at_once_get_two_versions(spark, scratch, monkeypatch):
    meet = threading.Barrier(2)
    real = R.append_entry

    def together(*a, **b):
        meet.wait(30)  # both have saved their model, both read the same log
        return real(*a, **b)

    monkeypatch.setattr(R, "append_entry", together)
    threads = [threading.Thread(target=R.register_model, args=(spark, scratch, "fraud", _fake(m), "roc_auc")) for m in (0.7, 0.8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    monkeypatch.undo()
    found = R.versions(spark, scratch).collect()
    assert sorted(r.version for r in found) == [1, 2] and len({r.model_path for r in found}) == 2
    R.set_alias(spark, scratch, "fraud", R.CHALLENGER, 2)
    row = R.metric_for_alias(spark, scratch, "fraud", R.CHALLENGER).collect()
    metric = {r.run_id: r.metric for r in R.runs(spark, scratch).collect()}
    assert len(row) == 1 and row[0].metric == metric[next(r.run_id for r in found if r.version == 2)]
    with pytest.raises(ValueError):
        R.set_alias(spark, scratch, "fraud", R.CHAMPION, 3)


def test_aliases_follow_the_log_when_the_clock_goes_back(spark, scratch, monkeypatch):
    for m in (0.7, 0.8):
        R.register_model(spark, scratch, "fraud", _fake(m), "roc_auc")
    times = iter([dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)])
    monkeypatch.setattr(R, "_now", lambda: next(times))
    R.set_alias(spark, scratch, "fraud", R.CHAMPION, 1)
    R.set_alias(spark, scratch, "fraud", R.CHAMPION, 2)  # later in the log, earlier by the clock
    assert [r.version for r in R.aliases(spark, scratch, "fraud").collect()] == [2]


def test_run_log_has_each_version_once(spark, scratch):
    schema = "model_version string, metric double"
    path = f"{scratch}/log"
    assert R.log_model_run(spark, path, spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], schema)) == 2
    assert R.log_model_run(spark, path, spark.createDataFrame([("b", 2.0), ("c", 3.0)], schema)) == 1
    got = R.run_log(spark, path, spark.createDataFrame([], schema).schema)
    assert sorted(r.model_version for r in got.collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("tie", [True, False])
def test_replay_is_the_gate_run_by_run(spark, tie):
    rnd = random.Random(5)
    metrics = [None if rnd.random() < 0.2 else rnd.choice([0.5, 0.6, 0.7, 0.8]) for _ in range(25)]
    rows = spark.createDataFrame([(i + 1, m) for i, m in enumerate(metrics)], "version int, metric double")
    got = {r.version: (r.champion, r.decision) for r in R.replay(rows, tie).collect()}
    champion = None
    for i, m in enumerate(metrics, 1):
        new, old = (R.NO_METRIC if x is None else x for x in (m, metrics[champion - 1] if champion else None))
        wins = champion is None or new > old or (tie and new == old)
        assert got[i] == (champion, "promote" if wins else "keep")
        champion = i if wins else champion
