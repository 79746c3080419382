"""Steps that run once, or leave rows where they lie, so that large tables cost no more than their share."""

import datetime as dt
import random
import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from lakehound.operators import roadgraph as G
from lakehound.operators.dedup import latest_by_key
from lakehound.plans.routes import route_edges
from lakehound.sources import snapshots as S


def _plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def _snap(spark, root):
    rnd = random.Random(5)
    at = dt.datetime(2024, 1, 15)

    def rows(n, note):
        return [(None if rnd.random() < 0.05 else f"k{rnd.randrange(150)}", rnd.randrange(1000), at + dt.timedelta(days=rnd.randrange(200)), f"{note}{i}")
                for i in range(n)]
    schema = "k string, v long, at timestamp, note string"
    order = [F.col("v").desc(), F.col("note").desc()]
    snap = S.snapshot(spark, root, spark.createDataFrame([], schema), ["k"], order, "at")
    return snap, [spark.createDataFrame(rows(n, x), schema) for n, x in ((300, "a"), (12, "b"), (90, "c"))], order


@pytest.mark.parametrize("keys,files", [(2 ** 21, 16), (2 ** 21, 0), (0, 16)])
def test_a_batch_folded_either_way_equals_the_dedup(spark, scratch, monkeypatch, keys, files):
    monkeypatch.setattr(S, "MOST_KEYS", keys)
    monkeypatch.setattr(S, "MOST_FILES", files)
    snap, batches, order = _snap(spark, scratch)
    seen = None
    for b in batches:
        b = b.filter("k IS NOT NULL")
        seen = b if seen is None else seen.unionByName(b)
        snap.append(b)
        snap.fold()
        assert sorted(map(tuple, snap.read().collect())) == sorted(map(tuple, latest_by_key(seen, ["k"], order).collect()))


def test_a_small_batch_leaves_stored_rows_where_they_lie(spark, scratch):
    snap, (first, second, _), _ = _snap(spark, scratch)
    snap.append(first)
    snap.fold()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near, far = snap._dealt(snap.ranges(), second)
        plan = _plan(far, "executedPlan")
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = {r.k for r in second.collect()}
    stored = snap.ranges().collect()
    assert near.count() + far.count() == len(stored)
    assert {r.k for r in stored} & keys <= {r.k for r in near.collect()}


def test_positions_of_a_route_are_merged_once(spark):
    pos = spark.range(60).select(
        F.concat(F.floor(F.col("id") / 6).cast("string"), F.lit("-"), (F.col("id") % 3).cast("string")).alias("pos_uuid"), (F.col("id") % 4).cast("string").alias("link_id"),
        F.lit("a").alias("road_type"), F.lit(50.0).alias("maxspeed"), F.col("id").cast("double").alias("speed_kmh"), F.lit(35.0).alias("latitude"), F.lit(135.0).alias("longitude"))
    merged = latest_by_key(pos, ["pos_uuid"], "speed_kmh")
    geo = spark.range(4).select(F.col("id").cast("string").alias("link_id"), F.lit(35.0).alias("mid_lat"), F.lit(135.0).alias("mid_lon"))
    edges = route_edges(merged, geo)
    assert "Window" not in _plan(edges)
    assert sorted(r.edge_key for r in edges.collect()) == sorted(f"{o}-{k}" for o in range(10) for k in (0, 1))


def _edges(spark):
    line = F.array(*[F.struct(F.lit(y).alias("lat"), F.lit(x).alias("lon")) for y, x in ((35.0, 135.0), (35.1, 135.1))])
    return spark.createDataFrame([("a", "b", "1"), ("b", "a", "2")], "src string, dst string, edge_key string").select(
        "src", "dst", "edge_key", F.concat_ws("_", "src", "dst").alias("link_id"), F.lit("primary").alias("road_type"), F.lit(50.0).alias("maxspeed"), line.alias("poly"))


def test_edges_are_made_once_for_both_ways(spark):
    both = G.add_reverse_edges(_edges(spark))
    assert "Union" not in _plan(both)
    assert sorted((r.src, r.dst, r.link_id, r.is_reverse, r.poly[0].lat) for r in both.collect()) == [
        ("a", "b", "a_b", False, 35.0), ("a", "b", "b_a", True, 35.1), ("b", "a", "a_b", True, 35.1), ("b", "a", "b_a", False, 35.0)]


def test_adjacency_lists_hold_only_the_columns_given(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node_id string")
    narrow = G.adjacency_lists(nodes, _edges(spark).select("src", "dst", "link_id"))
    assert {r.node_id: [(t.dst, t.link_id) for t in r.targets] for r in narrow.collect()} == {"a": [("b", "a_b")], "b": [("a", "b_a")], "c": []}
    assert narrow.schema["targets"].dataType.elementType.fieldNames() == ["dst", "link_id"]


def test_a_line_is_parsed_once(spark):
    from lakehound.functions.geo import parse_linestring
    edges = spark.createDataFrame([("l", "a", "b", "1", "LINESTRING (1 2, 3 4)"), ("m", "a", "b", "1", "LINESTRING (1 2)")],
                                  "link_id string, src string, dst string, edge_key string, text string").select("link_id", "src", "dst", "edge_key", parse_linestring("text").alias("poly"))
    links = G.link_geo(edges)
    assert _plan(links).count("split(") <= 2  # the line's points, and the two numbers of each
    assert [r.link_id for r in links.collect()] == ["l"]


def test_a_forest_gets_even_rows_for_all_tasks(spark, monkeypatch):
    from lakehound.plans import training
    monkeypatch.setattr(training, "PART_ROWS", 40)
    few = spark.range(1000).coalesce(1)
    sizes = [r["count"] for r in training.dealt(few).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 25 and max(sizes) <= 2 * 40
    monkeypatch.setattr(training, "PART_ROWS", 10 ** 6)
    assert training.dealt(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def _stored_while(spark, run):
    """What ``run`` returns, and the ids of the RDDs that were persisted with disk while it ran."""
    context, seen, over = spark.sparkContext._jsc, set(), threading.Event()

    def watch():
        while not over.wait(0.01):
            seen.update(k for k, rdd in context.getPersistentRDDs().items() if rdd.getStorageLevel().useDisk())
    t = threading.Thread(target=watch)
    t.start()
    try:
        return run(), seen
    finally:
        over.set()
        t.join()


@pytest.mark.parametrize("labels", [2, 3])
def test_a_forest_writes_no_rows_to_disk(spark, labels, monkeypatch):
    """the trees are those of MLlib's forest, with no number for each row and tree on disk beyond the bound of node ids."""
    from lakehound.plans import forest
    from lakehound.plans.training import build_pipeline
    monkeypatch.setattr(forest, "NODE_ID_BYTES", 3000 * 20 * 12 - 1)
    rows = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("c"), (F.col("id") * 37 % 101).cast("double").alias("x"),
        (F.col("id") % 24).cast("int").alias("hour"), F.pmod(F.xxhash64("id"), F.lit(labels)).cast("double").alias("y")).repartition(4).persist()
    assert rows.count() == 3000
    mine = {k for k in spark.sparkContext._jsc.getPersistentRDDs()}
    pipe = build_pipeline(["c"], ["x", "hour"], "y", n_trees=20, max_depth=6)
    model, stored = _stored_while(spark, lambda: pipe.fit(rows))
    assert not stored - mine
    own = RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=20, maxDepth=6, seed=42, maxBins=64, maxMemoryInMB=1024, cacheNodeIds=True)
    other, held = _stored_while(spark, lambda: Pipeline(stages=[*pipe.getStages()[:-1], own]).fit(rows))
    assert held - mine  # the watch does see what MLlib stores
    monkeypatch.setattr(forest, "NODE_ID_BYTES", 3000 * 20 * 12)
    fast, ids = _stored_while(spark, lambda: pipe.fit(rows))
    assert ids - mine
    text = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    assert text(model) == text(other) == text(fast) and model.stages[-1].numClasses == labels
    assert model.transform(rows).exceptAll(other.transform(rows)).count() == 0
    rows.unpersist()


def test_sides_of_a_training_are_stored_once(spark, monkeypatch):
    """while a forest grows only its training and test rows are held, not the rows they were cut from."""
    from lakehound.plans import training
    held = []

    def fit(pipe, rows):
        held.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
        return whole(pipe, rows)
    whole = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", fit)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    rows = spark.range(300).select(F.col("id").cast("string").alias("tx_uuid"), *[F.lit("a").alias(c) for c in training.FRAUD_CATEGORICAL],
                                   *[(F.col("id") % 9).alias(c) for c in training.FRAUD_NUMERIC], (F.col("id") % 3 == 0).cast("int").alias("is_fraud"))
    m = training.train_fraud(rows, n_trees=3, max_depth=3).metrics
    assert (m["n_train"], m["n_test"]) == (240, 60) and held == [before + 2]
    positions = spark.range(300).select(F.col("id").cast("string").alias("pos_uuid"), F.lit("a").alias("road_type"), *[
        (F.col("id") % 9).alias(c) for c in training.ROAD_NUMERIC], (F.col("id") % 3).alias("congestion"))
    m = training.train_congestion(positions, n_trees=3, max_depth=3, key="pos_uuid").metrics
    assert (m["n_train"], m["n_test"]) == (240, 60) and held == [before + 2] * 2
