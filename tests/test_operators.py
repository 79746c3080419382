"""Properties of the core operators."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakehound.operators import aggregates as A
from lakehound.operators.dedup import latest_by_key, max_version_row
from lakehound.operators.filters import bbox_filter, recent, time_filter
from lakehound.functions.scalar import dow_mon1, dow_sun1, hour_of
from lakehound.operators.metrics import auc_by_group
from lakehound.operators.topk import newest
from lakehound.plans import fraud_panels as P
from lakehound.sources import fixtures as X
from lakehound.sources.tables import Tables
from lakehound.streaming.changes import FRAUD_RULES, validate


def test_latest_by_key_idempotent_and_order_free(spark):
    raw = X.vehicle_positions_raw(Tables(spark, SF_SMALL))
    once = latest_by_key(raw, ["pos_uuid"], X.position_order())
    twice = latest_by_key(once, ["pos_uuid"], X.position_order())
    shuffled = latest_by_key(raw.repartition(7, "id").orderBy(F.rand(3)), ["pos_uuid"],
                             X.position_order())
    a = sorted(once.collect())
    assert a == sorted(twice.collect()) == sorted(shuffled.collect())
    assert once.count() == raw.select("pos_uuid").distinct().count()


def test_max_version_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, v int, p string")
    got = sorted(tuple(r) for r in max_version_row(df, ["k"], "v").collect())
    assert got == [("a", 3, "y"), ("b", 2, "z")]


def test_validate_partitions_input(spark):
    df = spark.createDataFrame(
        [("a", 5.0, 0, 10.0, 10.0), ("b", -1.0, 0, 10.0, 10.0), ("c", 3.0, 2, 95.0, 10.0),
         (None, 1.0, 1, 0.0, 0.0)],
        "tx_uuid string, amount double, is_fraud int, latitude double, longitude double",
    ).withColumn("created_at", F.current_timestamp())
    good, bad = validate(df, FRAUD_RULES)
    assert good.count() + bad.count() == df.count()
    reasons = {r.tx_uuid: set(r.reasons) for r in bad.collect()}
    assert reasons["b"] == {"amount_positive"}
    assert reasons["c"] == {"label_0_1", "lat_range"}
    assert reasons[None] == {"has_key"}


def test_bbox_filter_and_fallback(spark):
    df = spark.createDataFrame([(1, 35.0, 135.0), (2, 36.0, 136.0)], "id int, lat double, lon double")
    assert [r.id for r in bbox_filter(df, (35.5, 135.5, 34.5, 134.5)).collect()] == [1]
    assert sorted(r.id for r in bbox_filter(df, (0, 0, 1, 1)).collect()) == [1, 2]


def test_time_filter_closed_and_recent(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01 00:00:00', "
                   "TIMESTAMP'2024-01-01 00:10:00', INTERVAL 1 MINUTE)) AS ts")
    assert time_filter(df, "ts", "2024-01-01 00:02:00", "2024-01-01 00:04:00").count() == 3
    assert recent(df, "ts", "3 MINUTES", "max").count() == 3


def test_last_not_null(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, None)], "t int, v double")
    assert A.last_not_null(df, "t", "v").first()[0] == 0.7


def test_auc_matches_brute_force(spark):
    rows = [("g", i / 10, 1 if i % 3 == 0 else 0) for i in range(10)] + \
           [("g", 0.5, 1), ("g", 0.5, 0), ("h", 0.2, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r.g: r.auc for r in auc_by_group(df, ["g"], "s", "y").collect()}
    pos = [s for g, s, y in rows if g == "g" and y == 1]
    neg = [s for g, s, y in rows if g == "g" and y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got["g"] - brute) < 1e-12
    assert got["h"] is None


def test_backlog_then_nothing_unscored(spark):
    t = Tables(spark, SF_SMALL)
    tx = X.transactions(t)
    p = X.predictions(t, tx)
    backlog = P.unscored_features(tx, p)
    fake = backlog.select("tx_uuid", F.lit(0.1).alias("fraud_probability"))
    assert P.unscored_features(tx, p.select("tx_uuid").unionByName(fake.select("tx_uuid"))).count() == 0
    assert backlog.count() == tx.filter(F.col("id") % 10 == 0).count()


def test_auc_tells_close_scores_apart(spark):
    rows = [(0.300001, 0), (0.300002, 1), (0.300003, 0), (0.300004, 1), (1.0, 1), (0.0, 0), (None, 1)]
    df = spark.createDataFrame([("g", *r) for r in rows] + [(None, 0.5, 1), (None, 0.4, 0)], "g string, s double, y int")
    got = {r.g: r.auc for r in auc_by_group(df, ["g"], "s", "y").collect()}
    assert abs(got["g"] - 8 / 9) < 1e-12 and got[None] == 1.0


def test_newest_keeps_whole_hours(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, 0, id * 20) AS ts FROM range(12) "
                   "UNION ALL SELECT 99, NULL")
    assert sorted(r.id for r in newest(df, "ts", 4).collect()) == [6, 7, 8, 9, 10, 11]
    assert newest(df, "ts", 12).count() == 12 and newest(df, "ts", 13).count() == 13


def test_hour_and_weekday_in_a_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-06 20:30:00' AS ts")  # a Saturday evening in UTC
    assert tuple(df.select(hour_of("ts"), dow_sun1("ts"), dow_mon1("ts")).first()) == (20, 7, 6)
    zone = "Asia/Tokyo"
    assert tuple(df.select(hour_of("ts", zone), dow_sun1("ts", zone), dow_mon1("ts", zone)).first()) == (5, 1, 7)
