"""Streams: parsing edge cases, scoring with model reload, idempotent sinks, watermarks."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakehound.operators.dedup import latest_by_key
from lakehound.plans import queries_stream
from lakehound.plans.features import fraud_features
from lakehound.plans.training import save_model, train_fraud
from lakehound.schemas import FRAUD_EVENT_FULL, ROAD_EVENT
from lakehound.sources import fixtures as X
from lakehound.sources.sinks import write_predictions, writer_id
from lakehound.sources.tables import Tables
from lakehound.streaming.changes import (FRAUD_RULES, parse_change, read_change_stream,
                                         with_event_time)
from lakehound.session import shared_dir
from lakehound.streaming.replay import END, _ranges, files_per_batch, finished, state_by_file, write_in_order
from lakehound.streaming.scorer import ModelCache, ingest_stream, score_stream, start
from lakehound.streaming.windows import link_congestion_stream, minute_counts_stream


def _event(i, ts, key=True, amount=10.0):
    return json.dumps({"id": i, "tx_uuid": str(i) if key else None, "user_id": 1, "amount": amount,
                       "merchant_category": "click", "country": "NATION_1", "device": "web",
                       "latitude": 1.0, "longitude": 2.0, "source": "client-jp", "is_fraud": 0,
                       "created_at": ts, "unknown_field": "ignored"})


def _files(d):
    os.makedirs(d, exist_ok=True)
    a = [_event(i, f"2024-01-01T00:{i:02d}:00") for i in range(1, 20)]
    b = ["{not json", _event(100, "not-a-time"), _event(101, "2024-01-01T00:30:00", key=False),
         _event(5, "2024-01-01T00:05:00"),  # repeat of event 5
         _event(102, "2024-01-01T00:31:00")]
    with open(f"{d}/part-1.json", "w") as f:
        f.write("\n".join(a) + "\n")
    with open(f"{d}/part-2.json", "w") as f:
        f.write("\n".join(b) + "\n")


def _parsed(spark, d, max_files=None):
    src = {"kind": "files", "path": d}
    if max_files:
        src["max_files"] = max_files
    return with_event_time(parse_change(read_change_stream(spark, src), FRAUD_EVENT_FULL))


def test_ingest_splits_good_and_quarantine(spark, scratch):
    _files(f"{scratch}/in")
    q = ingest_stream(_parsed(spark, f"{scratch}/in"), f"{scratch}/tx", f"{scratch}/bad",
                      f"{scratch}/ck", FRAUD_RULES, available_now=True)
    q.awaitTermination()
    good = spark.read.parquet(f"{scratch}/tx")
    bad = spark.read.parquet(f"{scratch}/bad")
    assert good.count() == 21  # 19 + repeat + 102
    assert latest_by_key(good, ["tx_uuid"], "id").count() == 20  # repeat collapses on read
    reasons = {tuple(r.reasons) for r in bad.collect()}
    assert ("has_time",) in reasons and ("has_key",) in reasons


def test_score_stream_skips_without_model_then_scores_once(spark, scratch):
    _files(f"{scratch}/in")
    cache_state = {"path": None}
    models = ModelCache(lambda: None if cache_state["path"] is None else ("7", cache_state["path"]))
    out, ck = f"{scratch}/pred", f"{scratch}/ck"
    q = score_stream(_parsed(spark, f"{scratch}/in", max_files=1), models, out, ck,
                     available_now=True)
    q.awaitTermination()
    assert not os.path.exists(out)  # no model: batches skipped (X7)

    tx = X.transactions(Tables(spark, SF_SMALL))
    res = train_fraud(fraud_features(latest_by_key(tx, ["tx_uuid"], "id")), n_trees=5, max_depth=4)
    cache_state["path"] = save_model(res.model, f"{scratch}/model")
    with open(f"{scratch}/in/part-3.json", "w") as f:
        f.write(_event(200, "2024-01-01T00:40:00") + "\n")
    q = score_stream(_parsed(spark, f"{scratch}/in", max_files=1), models, out, ck,
                     available_now=True)
    q.awaitTermination()
    pred = spark.read.parquet(out)
    assert [r.tx_uuid for r in pred.collect()] == ["200"]  # restart: only the new file
    assert pred.first().model_version == "7"
    # replaying a batch id overwrites its partition instead of adding a copy
    batch = pred.first().batch_id
    row = spark.createDataFrame(pred.collect(), pred.schema).drop("batch_id", "writer")
    write_predictions(row, out, batch, writer_id(ck))
    assert spark.read.parquet(out).count() == 1
    # another writer with the same batch number adds its rows
    write_predictions(row, out, batch, "backlog")
    assert spark.read.parquet(out).count() == 2


def test_late_rows_are_dropped_by_watermark(spark, scratch):
    """Late input is judged against the watermark of the previous micro-batch."""
    d = f"{scratch}/late"
    os.makedirs(d)
    files = {
        "a.json": [_event(i, f"2024-01-01T01:{i:02d}:00") for i in range(0, 30)],
        "b.json": [_event(998, "2024-01-01T01:45:00")],
        "c.json": [_event(999, "2024-01-01T00:00:30")],  # older than 01:45 - 10 min
    }
    for k, (name, lines) in enumerate(files.items()):
        with open(f"{d}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(f"{d}/{name}", (1_700_000_000 + 100 * k, 1_700_000_000 + 100 * k))
    out = f"{scratch}/counts"
    q = start(minute_counts_stream(_parsed(spark, d, max_files=1), "10 minutes"), f"{scratch}/ck2",
              path=out, available_now=True)
    q.awaitTermination()
    dropped = sum(s.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for s in p["stateOperators"])
    rows = spark.read.parquet(out)
    assert dropped == 1
    assert rows.filter(F.col("time") < "2024-01-01 01:00:00").count() == 0
    assert rows.agg(F.sum("events")).first()[0] == 30  # 01:00..01:29 closed; 01:45 still open


def _tables(spark, folder):
    """Two parts, 40 links, 400 line items of eight days; some repeat their key, some have no time, link or speed."""
    spark.range(2).selectExpr("id AS p_partkey", "'Brand' AS p_brand", "1 AS p_size").write.parquet(f"{folder}/part.parquet")
    spark.range(400).selectExpr(
        "id div 2 AS l_orderkey", "id % 2 AS l_partkey", "if(id % 41 = 0, NULL, id % 40) AS l_suppkey",
        "if(id % 20 = 0, 1, cast(id % 2 AS int)) AS l_linenumber", "if(id % 37 = 0, NULL, cast(id % 50 AS double)) AS l_quantity",
        "cast(id AS double) AS l_extendedprice",
        "if(id % 43 = 0, NULL, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id div 50)) AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")


def test_link_congestion_state(spark, scratch, monkeypatch):
    """an event changes two rows of the state, not one for each window; the state has a partition for each file of a batch."""
    _tables(spark, scratch)
    seen = []
    monkeypatch.setattr(queries_stream, "finished", lambda q: (finished(q), seen.append(q)))
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "17")
    try:
        got = queries_stream.stream_link_congestion(spark, scratch)
        assert spark.conf.get(name) == "17"
    finally:
        spark.conf.set(name, before)
    pos = X.vehicle_positions(Tables(spark, scratch)).filter("created_at IS NOT NULL")
    want = (pos.select("link_id", "speed_kmh", F.expr("explode(sequence(0, 4)) AS k"), "created_at")
            .groupBy(F.expr("created_at - make_dt_interval(0, 0, k)").alias("ws"), "link_id")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("speed_kmh").alias("avg")))
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(((r.window_start, r.link_id, r.n, r.avg_speed) for r in got.filter("link_id IS NOT NULL").collect()), key=key) == sorted(
        ((r.ws, r.link_id, r.n, None if r.avg is None else round(r.avg, 2)) for r in want.filter("link_id IS NOT NULL").collect()), key=key)
    states = [s for p in seen[0].recentProgress for s in p["stateOperators"]]
    groups = pos.select("created_at", "link_id").distinct().count()
    assert sum(s["numRowsUpdated"] for s in states) <= 2 * (groups + 1)
    assert {s["numShufflePartitions"] for s in states} == {files_per_batch(spark)}


def test_windows_of_a_block_are_those_of_their_own(spark, scratch):
    """Blocks of any number of windows, lengths that the slide does not divide, times inside a minute and over midnight."""
    os.makedirs(f"{scratch}/in")
    times = [f"19{y}-12-31T23:{m:02d}:{(m * 7 + y) % 60:02d}.5" for y in (70, 71) for m in range(60)] + ["1971-01-01T00:01:00", "1972-01-02T00:00:00", "bad"]
    with open(f"{scratch}/in/a.json", "w") as f:
        f.write("\n".join(json.dumps({"pos_uuid": str(i), "link_id": None if i % 5 == 0 else f"l{i % 3}",
                                      "speed_kmh": None if i % 7 == 0 else float(i % 31), "created_at": t}) for i, t in enumerate(times)))
    rows = with_event_time(parse_change(read_change_stream(spark, {"kind": "files", "path": f"{scratch}/in"}), ROAD_EVENT))
    stored = with_event_time(parse_change(spark.read.text(f"{scratch}/in"), ROAD_EVENT)).filter("created_at < '1972-01-01 12:00:00'")
    for k, (length, slide, block) in enumerate((("5 minutes", "1 minute", 5), ("150 seconds", "1 minute", 4), ("5 minutes", "1 minute", 1))):
        want = (stored.groupBy(F.window("created_at", length, slide).alias("w"), "link_id")
                .agg(F.count(F.lit(1)).alias("n"), F.avg("speed_kmh").alias("avg")).select("w.start", "w.end", "link_id", "n", F.round("avg", 2)))
        out = f"{scratch}/out{k}"
        finished(start(link_congestion_stream(rows, "1 minute", length=length, slide=slide, block=block), f"{out}-ck", path=out, available_now=True))
        got = spark.read.parquet(out).select("window_start", "window_end", "link_id", "n", "avg_speed")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0, (length, slide, block)


def test_ranges_of_event_time(spark):
    rows = spark.createDataFrame([(v,) for v in (None, -5, 9, 10, 11, 20, 21, 1_700_000_000_000_000, 1_700_000_000_000_001)], "at long")
    cuts = [10, 20, 1_700_000_000_000_000]
    assert [(r["at"], r["slice"]) for r in _ranges(rows, cuts).collect()] == [
        (v, 0 if v is None else sum(c < v for c in cuts)) for (v,) in rows.collect()]
    assert {r["slice"] for r in _ranges(rows, []).collect()} == {0}


def test_a_replay_leaves_one_compressed_copy(spark, scratch):
    """the input's files are compressed, and the copies and shuffles that it was made from are gone."""
    base = os.path.dirname(shared_dir(spark))
    files = lambda d: {os.path.join(at, f) for at, _, names in os.walk(d) for f in names}
    local = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for d in local for f in files(d) if "shuffle_" in f and f.endswith(".data")}
    before, moved = files(base), shuffles()
    events = spark.range(20_000).select(
        F.when(F.col("id") % 97 != 0, F.to_json(F.struct("id", F.lit("a link that many events name").alias("link_id")))).alias("value"),
        F.when(F.col("id") % 89 != 0, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 1000)")).alias("created_at"))
    write_in_order(events, f"{scratch}/in", '{"id": "' + END + '", "at": "%s"}', "gzip")
    staged = files(base) - before
    assert not [f for f in staged if f.endswith(".parquet")] and not shuffles() - moved
    text = spark.read.text(f"{scratch}/in").filter("value <> ''")
    want = sorted([r.value for r in events.filter("value IS NOT NULL").collect()] + ['{"id": "' + END + '", "at": "2024-01-02T16:39:00"}'])
    assert sorted(r.value for r in text.collect()) == want
    written = [f for f in files(f"{scratch}/in") if "part-" in f and not f.endswith(".crc")]
    assert all(f.endswith(".txt.gz") for f in written) and len(written) == 2 * files_per_batch(spark) + 1
    assert sum(os.path.getsize(f) for f in written) < sum(map(len, want)) / 3


def test_state_of_a_replay_goes_after_some_batches(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.minBatchesToRetain", "spark.sql.streaming.stateStore.compression.codec"]
    before = [spark.conf.get(n) for n in names]
    with state_by_file(spark):
        assert [spark.conf.get(n) for n in names] == [str(files_per_batch(spark)), "5", "zstd"]
    assert [spark.conf.get(n) for n in names] == before
