"""Artifacts, metadata, existing columns, and the time cuts before a top-k."""

from pyspark.sql import functions as F

from lakehound.operators.filters import select_existing
from lakehound.operators.joins import scored_transactions
from lakehound.operators.topk import newest_joined, time_cut
from lakehound.plans import fraud_panels as P
from lakehound.sources import sinks
from lakehound.sources.tables import register_views
from conftest import SF_SMALL


def test_artifact_summary_with_metrics(spark, scratch):
    rows = spark.range(100)
    assert sinks.write_features(rows, f"{scratch}/features") == 100
    path = sinks.read_features(spark, f"{scratch}/features").inputFiles()[0].rsplit("/", 1)[0]
    sinks.write_metadata(spark, f"{scratch}/meta", "2024-01-01", {"roc_auc": 0.75, "n_train": 80, "note": None})
    one = sinks.artifact_summary(spark, path, f"{scratch}/meta").first()
    assert one.parts == rows.rdd.getNumPartitions() and one.bytes > 0 and one.modified and one.metrics == {"roc_auc": 0.75, "n_train": 80.0}
    assert sinks.artifact_summary(spark, path).first().metrics is None
    assert sinks.artifact_summary(spark, path, f"{scratch}/absent").first().metrics is None


def test_metadata_missing_or_broken_gives_nothing(spark, scratch):
    assert sinks.read_metadata(spark, f"{scratch}/absent").count() == 0
    with open(f"{scratch}/broken.json", "w") as f:
        f.write('{"trained_at": ')
    assert sinks.read_metadata(spark, f"{scratch}/broken.json").count() == 0
    sinks.write_metadata(spark, f"{scratch}/meta", "2024-01-01", {"accuracy": 0.5})
    assert sinks.read_metadata(spark, f"{scratch}/meta").first().metrics == {"accuracy": 0.5}


def test_select_existing(spark):
    assert select_existing(spark.range(1).withColumn("x", F.lit(1)), ["x", "absent", "id"]).columns == ["x", "id"]


def test_views(spark):
    register_views(spark, SF_SMALL, ["nation", "region"])
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25


def _tx(spark, n):
    at = F.expr("TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 97)")
    return spark.range(n).select(F.format_string("t%05d", "id").alias("tx_uuid"), at.alias("created_at"), *[F.lit("x").alias(c) for c in ("source", "country", "device", "merchant_category")],
                                 F.lit(1.0).alias("amount"), F.lit(2.0).alias("latitude"), F.lit(3.0).alias("longitude"))


def test_panels_when_the_newest_rows_have_no_partner(spark):
    """The cut widens until it holds enough joined rows; the result is that of the whole join."""
    t = _tx(spark, 3000).persist()
    p = t.filter(F.substring("tx_uuid", 2, 5).cast("int") < 700).select("tx_uuid", F.lit(0.5).alias("fraud_probability"), F.lit(1).alias("pred_label"), F.col("created_at").alias("scored_at"))
    got = P.recent_scored(p, t, 100).collect()
    want = scored_transactions(p, t).orderBy(F.col("created_at").desc(), "tx_uuid").limit(100).collect()
    assert [r.created_at for r in got] == [r.created_at for r in want]
    few = t.filter("tx_uuid < 't00040'")
    assert P.recent_scored(p, few, 100).count() == 40 and P.risk_map(p, few, 100).count() == 40 and P.risk_map(p, t, 100).count() == 100
    assert P.recent_scored(p.limit(0), t, 100).count() == 0
    rows = newest_joined(t, "created_at", 50, lambda d: scored_transactions(p.limit(0).unionByName(p), d))
    assert rows.count() >= 50


def test_backlog_batch_from_the_oldest_hours(spark):
    t = _tx(spark, 3000).persist()
    p = t.filter("tx_uuid < 't01000'").select("tx_uuid")
    got = [r.created_at for r in P.unscored_features(t, p, 200).collect()]
    assert got == [r.created_at for r in t.filter("tx_uuid >= 't01000'").orderBy("created_at", "tx_uuid").limit(200).collect()]
    assert P.unscored_features(t, p, 5000).count() == 2000
    assert t.select(time_cut(t, "created_at", 5000).alias("c")).first().c is None
