"""Ingest-side registered queries: row rules, CDC unwrap, counts and reconciliation."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.functions.scalar import clamp, dow_mon1, from_millis, hour_of, row_id, to_utc
from lakehound.operators import aggregates as A
from lakehound.operators.dedup import latest_by_key
from lakehound.plans.catalog import register
from lakehound.plans.oracle import ALL, fraud, road
from lakehound.schemas import FRAUD_EVENT_FULL, TRANSACTIONS
from lakehound.session import shared_dir
from lakehound.sources import fixtures as X
from lakehound.sources import sinks
from lakehound.sources.tables import Tables
from lakehound.streaming.changes import (FRAUD_REQUEST_RULES, FRAUD_RULES, ROAD_REQUEST_RULES, ROAD_RULES, cdc_unwrap, change_order,
                                         malformed, parse_change, read_change_stream, with_defaults, with_event_time)
from lakehound.streaming.scorer import RAW, ingest_stream


def rule_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """P8 summary: failures per rule (NULL counts as failed), one aggregate pass."""
    agg = df.agg(*[F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(n)
                   for n, c in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return agg.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, failed)")


def _rules_sql(rules: dict[str, str], table: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed FROM {table}"
        for n, c in rules.items())


@register("validation_report", fraud(_rules_sql(FRAUD_RULES, "transactions")))
def validation_report(spark, sf_dir):
    return rule_report(X.transactions(Tables(spark, sf_dir)), FRAUD_RULES)


@register("validation_report_positions", road(_rules_sql(ROAD_RULES, "vehicle_positions")))
def validation_report_positions(spark, sf_dir):
    return rule_report(X.vehicle_positions(Tables(spark, sf_dir)), ROAD_RULES)


REQUESTS_SQL = """,
requests AS (SELECT * REPLACE (
    CASE WHEN id % 23 <> 0 THEN tx_uuid END AS tx_uuid, CASE WHEN id % 47 <> 0 THEN user_id END AS user_id,
    CASE WHEN id % 17 = 0 THEN -amount ELSE amount END AS amount, CASE WHEN id % 53 <> 0 THEN merchant_category END AS merchant_category,
    CASE WHEN id % 29 <> 0 THEN country END AS country, CASE WHEN id % 59 <> 0 THEN device END AS device,
    CASE WHEN id % 61 <> 0 THEN latitude + CASE WHEN id % 19 = 0 THEN 200.0 ELSE 0.0 END END AS latitude,
    CASE WHEN id % 67 <> 0 THEN longitude + CASE WHEN id % 41 = 0 THEN 400.0 ELSE 0.0 END END AS longitude,
    CASE WHEN id % 71 <> 0 THEN source END AS source, CASE WHEN id % 31 = 0 THEN 7 WHEN id % 13 <> 0 THEN is_fraud END AS is_fraud,
    CASE WHEN id % 37 <> 0 THEN created_at END AS created_at) FROM transactions)
"""

POSITION_REQUESTS_SQL = """,
requests AS (SELECT * REPLACE (
    CASE WHEN i % 47 <> 0 THEN pos_uuid END AS pos_uuid, CASE WHEN i % 41 <> 0 THEN vehicle_id END AS vehicle_id,
    latitude + CASE WHEN i % 19 = 0 THEN 100.0 ELSE 0.0 END AS latitude, longitude + CASE WHEN i % 59 = 0 THEN 400.0 ELSE 0.0 END AS longitude,
    CASE WHEN i % 17 = 0 THEN -1.0 ELSE speed_kmh END AS speed_kmh, CASE WHEN i % 23 <> 0 THEN link_id END AS link_id,
    CASE WHEN i % 53 <> 0 THEN road_type END AS road_type, CASE WHEN i % 37 = 0 THEN -5.0 ELSE maxspeed END AS maxspeed,
    CASE WHEN i % 29 = 0 THEN 24 ELSE sim_hour END AS sim_hour, CASE WHEN i % 31 = 0 THEN 0 ELSE sim_dow END AS sim_dow,
    CASE WHEN i % 43 <> 0 THEN created_at END AS created_at)
  FROM (SELECT *, CAST(split_part(pos_uuid, '-', 1) AS BIGINT) AS i FROM vehicle_positions) v)
"""


@register("request_report", fraud(REQUESTS_SQL + _rules_sql(FRAUD_REQUEST_RULES, "requests")))
def request_report(spark, sf_dir):
    """Failures by rule of requests that break them, required columns too."""
    return rule_report(X.requests(X.transactions(Tables(spark, sf_dir))), FRAUD_REQUEST_RULES)


@register("request_report_positions", road(POSITION_REQUESTS_SQL + _rules_sql(ROAD_REQUEST_RULES, "requests")))
def request_report_positions(spark, sf_dir):
    return rule_report(X.position_requests(X.vehicle_positions(Tables(spark, sf_dir))), ROAD_REQUEST_RULES)


def _reasons_sql(rules: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in rules.items()) + ")"


@register("ingest_split", fraud(REQUESTS_SQL + f"""
SELECT {_reasons_sql(FRAUD_RULES)} AS reasons, count(*) AS n FROM (SELECT * REPLACE (
  CASE WHEN id % 43 <> 0 THEN tx_uuid END AS tx_uuid, CASE WHEN id % 43 <> 0 THEN amount END AS amount, CASE WHEN id % 43 <> 0 THEN is_fraud END AS is_fraud,
  CASE WHEN id % 43 <> 0 THEN latitude END AS latitude, CASE WHEN id % 43 <> 0 THEN longitude END AS longitude,
  CASE WHEN id % 43 <> 0 THEN created_at END AS created_at) FROM requests) r GROUP BY 1"""))
def ingest_split(spark, sf_dir):
    """Requests as a stream of JSON lines, every 43rd of them cut short, into the table or quarantine."""
    root = shared_dir(spark, "ingest")
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    rows = X.requests(X.transactions(Tables(spark, sf_dir)))
    text = F.to_json(F.struct(*rows.columns, F.lit("ignored").alias("unknown_field")), fmt)
    rows.select(F.when(F.col("id") % 43 == 0, F.substring(text, 1, 12)).otherwise(text).alias("value")).write.text(os.path.join(root, "in"))
    stream = with_event_time(parse_change(read_change_stream(spark, {"path": os.path.join(root, "in")}), FRAUD_EVENT_FULL, raw=RAW))
    paths = [os.path.join(root, x) for x in ("table", "quarantine", "checkpoint")]
    ingest_stream(stream, *paths, FRAUD_RULES, available_now=True).awaitTermination()
    good, bad = spark.read.parquet(paths[0]), spark.read.parquet(paths[1])
    both = good.select(F.lit("").alias("reasons")).unionByName(bad.select(F.concat_ws(",", "reasons").alias("reasons")))
    return both.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


@register("request_defaults", fraud(REQUESTS_SQL + """
SELECT id, coalesce(is_fraud, 0) AS is_fraud, true AS has_time FROM requests"""))
def request_defaults(spark, sf_dir):
    """A label that is not given is 0, the ingest time is now."""
    rows = with_defaults(X.requests(X.transactions(Tables(spark, sf_dir))))
    return rows.select("id", "is_fraud", F.col("ingested_at").isNotNull().alias("has_time"))


@register("malformed_changes", fraud("""
SELECT count(*) FILTER (id % 97 = 0) AS malformed, count(*) FILTER (id % 97 = 0 AND id % 2 = 0) AS not_json FROM transactions"""))
def malformed_changes(spark, sf_dir):
    """Change rows that are no envelope, with their text."""
    tx = X.transactions(Tables(spark, sf_dir))
    log = X.change_envelopes(tx).select("value", "_offset")
    broken = tx.filter(F.col("id") % 97 == 0).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("{broken "), "tx_uuid")).otherwise(F.lit('{"after": {}, "op": "x"}')).alias("value"), F.col("id").alias("_offset"))
    found = malformed(log.unionByName(broken), TRANSACTIONS)
    return found.agg(F.count(F.lit(1)).alias("malformed"), F.count_if(F.col("value").startswith("{broken")).alias("not_json"))


@register("append_idempotent", fraud("SELECT tx_uuid, amount, created_at FROM transactions"))
def append_idempotent(spark, sf_dir):
    """The same rows sent twice, and once more in part, leave one copy."""
    tx = X.transactions(Tables(spark, sf_dir)).select("tx_uuid", "amount", "created_at")
    path = os.path.join(shared_dir(spark, "append"), "table")
    for part in (tx.filter(F.col("amount") > 50), tx, tx):
        sinks.append_rows(part, path)
    return spark.read.parquet(path).select(*tx.columns)


@register("row_ids", fraud("SELECT tx_uuid, sha256(concat_ws(chr(1), user_id, merchant_category, tx_uuid)) AS row_id FROM transactions"))
def row_ids(spark, sf_dir):
    """ids from the columns that tell rows apart."""
    return X.transactions(Tables(spark, sf_dir)).select("tx_uuid", row_id("user_id", "merchant_category", "tx_uuid").alias("row_id"))


@register("dimension_refresh", road("SELECT * FROM link_geo WHERE mid_lat > 34.91"))
def dimension_refresh(spark, sf_dir):
    """A refresh from the table itself; readers then see the new version alone."""
    path = shared_dir(spark, "dimension")
    sinks.refresh_dimension(X.link_geo(Tables(spark, sf_dir)), path)
    sinks.refresh_dimension(sinks.read_dimension(spark, path).filter("mid_lat > 34.91"), path)
    return sinks.read_dimension(spark, path)


@register("time_columns", fraud("""
SELECT tx_uuid, CAST(isodow(created_at) AS INTEGER) AS dow_mon1, created_at - INTERVAL 9 HOUR AS utc,
  CAST(hour(created_at + INTERVAL 9 HOUR) AS INTEGER) AS hour_tokyo, date_trunc('millisecond', created_at) AS from_millis,
  least(greatest(amount, 10.0), 50.0) AS clamped FROM transactions"""))
def time_columns(spark, sf_dir):
    """weekday from Monday, a zone's wall clock to UTC and back, epoch milliseconds, limits."""
    at = F.col("created_at").cast("timestamp")
    return X.transactions(Tables(spark, sf_dir)).select(
        "tx_uuid", dow_mon1("created_at").alias("dow_mon1"), to_utc(at, "Asia/Tokyo").cast("timestamp_ntz").alias("utc"),
        hour_of("created_at", "Asia/Tokyo").alias("hour_tokyo"), from_millis(F.unix_millis(at)).cast("timestamp_ntz").alias("from_millis"),
        clamp("amount", 10.0, 50.0).alias("clamped"))


def _change_log(spark, sf_dir) -> DataFrame:
    """The change log written once to the shared folder, read back like a topic dump."""
    tx = X.transactions(Tables(spark, sf_dir))
    path = os.path.join(shared_dir(spark, "changes"), "log")
    X.change_envelopes(tx).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_NEWEST = """CASE WHEN id % 22 = 0 THEN amount * 2 WHEN id % 10 = 0 THEN amount - 3
  WHEN id % 5 = 0 THEN amount + 1 WHEN id % 7 = 0 THEN amount + 0.5 ELSE amount END AS amount"""


@register("cdc_current_drop_deletes", fraud(f"""
SELECT tx_uuid, {_NEWEST},
  CASE WHEN id % 22 = 0 THEN 'c' WHEN id % 5 = 0 OR id % 7 = 0 THEN 'u' ELSE 'c' END AS op
FROM transactions"""))
def cdc_current_drop_deletes(spark, sf_dir):
    """S3 default: deletes and tombstones dropped, so deleted rows keep their last image."""
    rows = cdc_unwrap(_change_log(spark, sf_dir), TRANSACTIONS)
    return latest_by_key(rows, ["tx_uuid"], change_order()).select("tx_uuid", "amount", "op")


@register("cdc_current_flag_deletes", fraud(f"""
SELECT tx_uuid, {_NEWEST}
FROM transactions WHERE id % 11 <> 0 OR id % 22 = 0"""))
def cdc_current_flag_deletes(spark, sf_dir):
    """S3 ``flag``: deletes kept as flagged rows; after the versioned read they are removed."""
    rows = cdc_unwrap(_change_log(spark, sf_dir), TRANSACTIONS, deletes="flag")
    cur = latest_by_key(rows, ["tx_uuid"], change_order())
    return cur.filter(~F.col("is_deleted")).select("tx_uuid", "amount")


@register("table_counts", ALL + """
SELECT 'transactions' AS "table", count(*) AS n FROM transactions
UNION ALL SELECT 'predictions', count(*) FROM predictions
UNION ALL SELECT 'vehicle_positions', count(*) FROM vehicle_positions
UNION ALL SELECT 'congestion_pred', count(*) FROM congestion_pred""")
def table_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    pos = X.vehicle_positions(t)
    return A.table_counts({"transactions": tx, "predictions": X.predictions(t, tx),
                           "vehicle_positions": pos, "congestion_pred": X.congestion_pred(t, pos)})


@register("reconcile", fraud("""
SELECT 'only_in_transactions' AS side, count(*) AS n FROM transactions t
  WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.tx_uuid = t.tx_uuid)
UNION ALL SELECT 'only_in_predictions', count(*) FROM predictions p
  WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE p.tx_uuid = t.tx_uuid)
UNION ALL SELECT 'transactions', count(*) FROM transactions
UNION ALL SELECT 'predictions', count(*) FROM predictions"""))
def reconcile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tx = X.transactions(t)
    p = X.predictions(t, tx)
    return reconcile_keys(tx, p, "tx_uuid", "transactions", "predictions")


def reconcile_keys(a: DataFrame, b: DataFrame, key: str, a_name: str, b_name: str) -> DataFrame:
    """Key differences both ways plus both counts."""
    ka, kb = a.select(key), b.select(key)
    parts = {f"only_in_{a_name}": ka.join(kb, key, "left_anti"),
             f"only_in_{b_name}": kb.join(ka, key, "left_anti"), a_name: ka, b_name: kb}
    return A.table_counts(parts).withColumnRenamed("table", "side")
