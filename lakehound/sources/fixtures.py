"""Warehouse tables derived from the driver's star schema.

The driver ships TPC-H-like tables plus an ``events`` table. The operational
tables of this library (``transactions``, ``predictions``, ``vehicle_positions``,
``link_geo``, ``congestion_pred``) are derived from them by deterministic rules,
so every query's work grows with the input. The same rules are written as SQL
in :mod:`lakehound.plans.oracle` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions.scalar import congestion_level
from lakehound.operators.dedup import latest_by_key
from lakehound.operators.topk import newest_joined
from lakehound.schemas import TRANSACTIONS
from lakehound.session import shared_dir
from lakehound.sources.snapshots import Snapshot, snapshot
from lakehound.sources.tables import Tables

# Fixed values of the stand-in rules (shared with the oracle SQL).
DEVICES = ("ios", "android", "web", "pos")  # by event_id % 4
SOURCES = ("client-jp", "client-eu", "client-us", "client-fraud")  # by user_id % 4
MODEL_VERSION = "v1"

# Total order for picking one row per pos_uuid (X1: id alone ties).
def position_order() -> list:
    return [F.col("id").desc(), F.col("tie").desc(), F.col("speed_kmh").desc(),
            F.col("vehicle_id").asc(), F.col("link_id").asc(), F.col("created_at").desc()]


def _pick(c, values) -> F.Column:
    expr = None
    for i, v in enumerate(values[:-1]):
        expr = (F.when(c == i, F.lit(v)) if expr is None else expr.when(c == i, F.lit(v)))
    return expr.otherwise(F.lit(values[-1]))


def customer_country(t: Tables) -> DataFrame:
    """customer key -> nation name and key; nation is a 25-row dimension."""
    nation = t.nation.select("n_nationkey", "n_name")
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))


def transactions(t: Tables) -> DataFrame:
    """Card transactions: one per event, country from the customer's nation."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    j = e.join(customer_country(t), F.col("user_id") == F.col("c_custkey"))
    eid, nk, amount = F.col("event_id"), F.col("n_nationkey"), F.col("value")
    threshold = (F.lit(5)
                 + F.when(amount > 80, 40).otherwise(0)
                 + F.when(nk % 8 == 0, 20).otherwise(0)
                 + F.when(eid % 4 == 2, 15).otherwise(0))
    return j.select(
        eid.alias("id"),
        eid.cast("string").alias("tx_uuid"),
        F.col("user_id"),
        amount.alias("amount"),
        F.col("event_type").alias("merchant_category"),
        F.col("n_name").alias("country"),
        _pick(eid % 4, DEVICES).alias("device"),
        ((nk * 7) % 120 - 60).cast("double").alias("latitude"),
        ((nk * 14) % 300 - 150).cast("double").alias("longitude"),
        _pick(F.col("user_id") % 4, SOURCES).alias("source"),
        F.when((eid * 7919) % 100 < threshold, 1).otherwise(0).alias("is_fraud"),
        F.col("ts").alias("created_at"),
    )


def predictions(t: Tables, tx: DataFrame | None = None) -> DataFrame:
    """Scores for nine transactions in ten (every tenth is left unscored)."""
    tx = transactions(t) if tx is None else tx
    p = (F.lit(5)
         + F.when(F.col("amount") > 80, 45).otherwise(0)
         + F.when(F.col("device") == "web", 15).otherwise(0)
         + F.col("id") % 30)
    return (tx.filter(F.col("id") % 10 != 0)
            .select("tx_uuid", "created_at", p.alias("p"))
            .select(
                "tx_uuid",
                (F.col("p").cast("double") / 100).alias("fraud_probability"),
                F.when(F.col("p") >= 50, 1).otherwise(0).alias("pred_label"),
                F.lit(MODEL_VERSION).alias("model_version"),
                (F.col("created_at") + F.expr("INTERVAL 1 SECOND")).alias("scored_at"),
            ))


def vehicle_positions_raw(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """Vehicle positions as ingested: one per line item, duplicates per pos_uuid kept."""
    part = t.part.select("p_partkey", "p_brand", "p_size")
    li = (t.lineitem if lineitem is None else lineitem).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_shipdate")
    j = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.col("l_partkey").alias("id"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("pos_uuid"),
        F.col("l_partkey").cast("string").alias("vehicle_id"),
        (F.lit(34.9) + F.col("l_suppkey").cast("double") / 1000
         + F.col("l_linenumber").cast("double") / 10000).alias("latitude"),
        (F.lit(135.8) + (F.col("l_partkey") % 1000).cast("double") / 1000).alias("longitude"),
        F.col("l_quantity").alias("speed_kmh"),
        F.col("l_suppkey").cast("string").alias("link_id"),
        F.col("p_brand").alias("road_type"),
        (F.lit(30) + (F.col("p_size") % 5) * 10).cast("double").alias("maxspeed"),
        (F.col("l_orderkey") % 24).cast("int").alias("sim_hour"),
        (F.col("l_orderkey") % 7 + 1).cast("int").alias("sim_dow"),
        F.col("l_extendedprice").alias("tie"),
        F.col("l_shipdate").alias("created_at"),
    )


def vehicle_positions(t: Tables) -> DataFrame:
    """Merged read of the positions table: latest row per pos_uuid."""
    return latest_by_key(vehicle_positions_raw(t), ["pos_uuid"], position_order()).drop("tie")


_snapshots: dict[tuple, Snapshot] = {}


def stored_positions(t: Tables) -> Snapshot:
    """The positions table kept as a snapshot by month: bulk load, then a batch of changes of the last two months.

    Built once for a session and set of input files; panels read the ranges they need.
    """
    raw = vehicle_positions_raw(t)
    key = (t.spark.sparkContext.applicationId, t.sf_dir, *t.lineitem.inputFiles(), *t.part.inputFiles())
    if key not in _snapshots:
        snap = snapshot(t.spark, shared_dir(t.spark, "positions"), raw, ["pos_uuid"], position_order(), "created_at")
        newest = newest_joined(t.lineitem, "l_shipdate", 1, lambda li: vehicle_positions_raw(t, li)).agg(F.max("created_at")).scalar()
        late = (F.col("created_at") > newest - F.expr("INTERVAL 60 DAYS")) & (F.col("id") % 3 == 0)
        # the second filter reaches the scan, so all rows are joined once only
        for batch in (~F.coalesce(late, F.lit(False)), late):
            snap.append(raw.filter(batch))
            snap.fold()
        _snapshots[key] = snap
    return _snapshots[key]


def link_geo(t: Tables) -> DataFrame:
    """Link dimension: one fixed midpoint and bearing per link (supplier)."""
    s = F.col("s_suppkey")
    return t.supplier.select(
        s.cast("string").alias("link_id"),
        (F.lit(34.9) + s.cast("double") / 1000).alias("mid_lat"),
        (F.lit(135.8) + s.cast("double") / 1000).alias("mid_lon"),
        ((s * 37) % 360).cast("double").alias("bearing"),
    )


def congestion_pred(t: Tables, pos: DataFrame | None = None) -> DataFrame:
    """Stored congestion scores: actual level from speed, prediction off by one for id % 5 == 0."""
    pos = vehicle_positions(t) if pos is None else pos
    actual = congestion_level(F.col("speed_kmh"))
    return pos.select(
        "pos_uuid", "vehicle_id", "latitude", "longitude", "link_id", "road_type", "sim_hour",
        ((actual + F.when(F.col("id") % 5 == 0, 1).otherwise(0)) % 3).alias("pred_congestion"),
        ((F.col("id") % 50 + 50).cast("double") / 100).alias("pred_proba"),
        actual.alias("actual_congestion"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.col("created_at").alias("event_time"),
        (F.col("created_at") + F.expr("INTERVAL 1 SECOND")).alias("scored_at"),
    )


def requests(tx: DataFrame) -> DataFrame:
    """Ingest requests as clients send them: transactions, some of which break a rule or lack a column."""
    i = F.col("id")
    return tx.select(
        "id", F.when(i % 23 != 0, F.col("tx_uuid")).alias("tx_uuid"), F.when(i % 47 != 0, F.col("user_id")).alias("user_id"),
        F.when(i % 17 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.when(i % 53 != 0, F.col("merchant_category")).alias("merchant_category"), F.when(i % 29 != 0, F.col("country")).alias("country"),
        F.when(i % 59 != 0, F.col("device")).alias("device"), F.when(i % 61 != 0, F.col("latitude") + F.when(i % 19 == 0, 200.0).otherwise(0.0)).alias("latitude"),
        F.when(i % 67 != 0, F.col("longitude") + F.when(i % 41 == 0, 400.0).otherwise(0.0)).alias("longitude"),
        F.when(i % 71 != 0, F.col("source")).alias("source"), F.when(i % 31 == 0, 7).when(i % 13 != 0, F.col("is_fraud")).alias("is_fraud"),
        F.when(i % 37 != 0, F.col("created_at")).alias("created_at"))


def position_requests(pos: DataFrame) -> DataFrame:
    """Position requests as vehicles send them; the rules are broken by order number, so that vehicles of all kinds do."""
    i = F.split("pos_uuid", "-")[0].cast("long")
    return pos.select(
        "id", F.when(i % 47 != 0, F.col("pos_uuid")).alias("pos_uuid"), F.when(i % 41 != 0, F.col("vehicle_id")).alias("vehicle_id"),
        (F.col("latitude") + F.when(i % 19 == 0, 100.0).otherwise(0.0)).alias("latitude"), (F.col("longitude") + F.when(i % 59 == 0, 400.0).otherwise(0.0)).alias("longitude"),
        F.when(i % 17 == 0, -1.0).otherwise(F.col("speed_kmh")).alias("speed_kmh"), F.when(i % 23 != 0, F.col("link_id")).alias("link_id"),
        F.when(i % 53 != 0, F.col("road_type")).alias("road_type"), F.when(i % 37 == 0, -5.0).otherwise(F.col("maxspeed")).alias("maxspeed"),
        F.when(i % 29 == 0, 24).otherwise(F.col("sim_hour")).alias("sim_hour"), F.when(i % 31 == 0, 0).otherwise(F.col("sim_dow")).alias("sim_dow"),
        F.when(i % 43 != 0, F.col("created_at")).alias("created_at"))


def change_envelopes(tx: DataFrame) -> DataFrame:
    """Change log of the transactions table as CDC envelopes (JSON ``value``, ``_offset``).

    Every row is created. Every 7th is updated in the same millisecond (only the offset
    tells the order), every 5th a second later, every 10th again to a smaller amount;
    every 11th is deleted and every 22nd created anew; every 13th key gets a tombstone.
    """
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    amount = F.col("amount")
    ms = F.unix_millis(F.col("created_at").cast("timestamp"))
    none = F.lit(None).cast(TRANSACTIONS)

    def row(value):
        return F.struct(*[value.alias(c) if c == "amount" else F.col(c) for c in TRANSACTIONS.fieldNames()])

    def change(every, step, op, later, before, after):
        body = F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"), (ms + later).alias("ts_ms"))
        return tx.filter(F.col("id") % every == 0).select(F.to_json(body, fmt).alias("value"), (F.col("id") * 10 + step).alias("_offset"))

    log = [change(1, 0, "c", 0, none, row(amount)), change(7, 1, "u", 0, row(amount), row(amount + 0.5)),
           change(5, 2, "u", 1000, row(amount), row(amount + 1)), change(10, 3, "u", 1500, row(amount + 1), row(amount - 3)),
           change(11, 4, "d", 2000, row(amount), none), change(22, 5, "c", 3000, none, row(amount * 2)),
           tx.filter(F.col("id") % 13 == 0).select(F.lit(None).cast("string").alias("value"), (F.col("id") * 10 + 6).alias("_offset"))]
    out = log[0]
    for part in log[1:]:
        out = out.unionByName(part)
    return out
