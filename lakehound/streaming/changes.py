"""Change-stream sources and parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.functions.scalar import parse_ts
from lakehound.schemas import cdc_envelope


def read_change_stream(spark: SparkSession, source: dict) -> DataFrame:
    """A streaming frame with a string ``value`` column.

    ``source``: ``{"kind": "kafka", "bootstrap": ..., "topic": ..., "starting": "earliest"}``
    (needs the Kafka connector on the classpath) or ``{"kind": "files", "path": ...,
    "max_files": n}`` - one JSON document per line, the same payload as the topic.
    """
    kind = source.get("kind", "files")
    if kind == "kafka":
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", source["bootstrap"])
               .option("subscribe", source["topic"])
               .option("startingOffsets", source.get("starting", "earliest"))
               .load())
        return raw.select(F.col("value").cast("string").alias("value"), F.col("topic").alias("_topic"),
                          F.col("partition").alias("_partition"), F.col("offset").alias("_offset"),
                          F.col("timestamp").alias("_sent_at"))
    r = spark.readStream.format("text")
    if source.get("max_files"):
        r = r.option("maxFilesPerTrigger", int(source["max_files"]))
    return r.load(source["path"]).select("value")


def _parsed_once(df: DataFrame, value: str, schema: T.StructType, keep) -> DataFrame:
    """Parse ``value`` once per row and expand the struct.

    The struct goes through ``inline`` (a generator), so later filters on the
    parsed fields stay above it instead of being pushed down as extra
    ``from_json`` calls. Unparseable values (NULL struct) produce no row.
    """
    parsed = F.filter(F.array(F.from_json(F.col(value).cast("string"), schema)),
                      lambda x: x.isNotNull())
    return df.select(F.inline(parsed), *keep)


def parse_change(df: DataFrame, schema: T.StructType, value: str = "value", raw: str | None = None) -> DataFrame:
    """JSON value -> typed columns; unknown fields are ignored.

    ``raw`` names a column that keeps the text as it came, for quarantine.

    Other input columns (e.g. the Kafka offset) are kept. Malformed JSON
    gives a row of NULLs or no row; drop those with :func:`require_key`.
    """
    keep = [F.col(c) for c in df.columns if c != value] + ([F.col(value).alias(raw)] if raw else [])
    return _parsed_once(df, value, schema, keep)


def cdc_unwrap(df: DataFrame, row_schema: T.StructType, deletes: str = "drop",
               value: str = "value") -> DataFrame:
    """Change envelope -> after-image rows.

    Tombstones (NULL value) are always dropped. ``deletes="drop"`` drops
    ``op = 'd'``; ``deletes="flag"`` keeps them as the before-image with
    ``is_deleted = true`` (apply after the versioned read). ``ts_ms`` and all
    other input columns (topic, partition, offset) stay, so a versioned read
    can take the newest change of a key: see :func:`change_order`.
    """
    rest = [c for c in df.columns if c != value]
    e = _parsed_once(df.filter(F.col(value).isNotNull()), value, cdc_envelope(row_schema), rest)
    if deletes == "drop":
        return e.filter(F.col("op") != "d").select("after.*", "op", "ts_ms", *rest)
    if deletes == "flag":
        img = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        return e.select(img.alias("_r"), "op", "ts_ms", *rest).select(
            "_r.*", "op", "ts_ms", *rest, (F.col("op") == "d").alias("is_deleted"))
    raise ValueError("deletes must be 'drop' or 'flag'")


def change_order(offset: str = "_offset") -> list[Column]:
    """Newest change first: change time, then the position in the topic.

    All changes of a key are in one partition of the topic, so offsets order them.
    """
    return [F.col("ts_ms").desc(), F.col(offset).desc()]


def malformed(df: DataFrame, row_schema: T.StructType, value: str = "value") -> DataFrame:
    """Change rows that are no envelope (bad JSON, or no operation), with their text and position."""
    e = F.from_json(F.col(value).cast("string"), cdc_envelope(row_schema))
    return df.filter(F.col(value).isNotNull() & F.coalesce(e["op"], F.lit("")).isin("c", "u", "d", "r").__invert__())


def with_event_time(df: DataFrame, text: str = "created_at", out: str = "created_at") -> DataFrame:
    """Lenient timestamp parse (bad text -> NULL, not an error)."""
    return df.withColumn(out, parse_ts(F.col(text)))


def _required(*columns: str) -> dict[str, str]:
    return {f"has_{c}": f"{c} IS NOT NULL" for c in columns}


# Row rules of the ingest and prediction APIs (P8), as (name, predicate) pairs. A column with a default may be NULL.
FRAUD_RULES = {
    "amount_positive": "amount > 0",
    "label_0_1": "is_fraud IS NULL OR is_fraud BETWEEN 0 AND 1",
    "lat_range": "latitude IS NULL OR latitude BETWEEN -90 AND 90",
    "lon_range": "longitude IS NULL OR longitude BETWEEN -180 AND 180",
    "has_key": "tx_uuid IS NOT NULL",
    "has_time": "created_at IS NOT NULL",
}
#: With the columns that a full ingest request must bring.
FRAUD_REQUEST_RULES = FRAUD_RULES | _required("user_id", "merchant_category", "country", "device", "latitude", "longitude", "source")
ROAD_RULES = {
    "lat_range": "latitude BETWEEN -90 AND 90",
    "lon_range": "longitude BETWEEN -180 AND 180",
    "speed_nonneg": "speed_kmh >= 0",
    "maxspeed_nonneg": "maxspeed >= 0",
    "hour_range": "sim_hour BETWEEN 0 AND 23",
    "dow_range": "sim_dow BETWEEN 1 AND 7",
    "has_key": "pos_uuid IS NOT NULL",
    "has_time": "created_at IS NOT NULL",
}
ROAD_REQUEST_RULES = ROAD_RULES | _required("vehicle_id", "link_id", "road_type")
#: What a row needs to be scored by a stream.
SCORE_RULES = {
    "fraud": {k: FRAUD_RULES[k] for k in ("amount_positive", "has_key", "has_time")},
    "congestion": ROAD_RULES,
}
PREDICT_RULES = {
    "amount_positive": "amount > 0",
    "hour_range": "hour BETWEEN 0 AND 23",
    "dow_range": "dow BETWEEN 1 AND 7",
}


def violations(rules: dict[str, str]) -> Column:
    """Array of the names of failed rules (a NULL result counts as failed)."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name)) for name, cond in rules.items()]))


def validate(df: DataFrame, rules: dict[str, str]):
    """Split rows into (good, bad); bad rows carry a ``reasons`` array."""
    v = df.withColumn("reasons", violations(rules))
    return (v.filter(F.size("reasons") == 0).drop("reasons"), v.filter(F.size("reasons") > 0))


def with_defaults(df: DataFrame, label: str | None = "is_fraud",
                  times=("ingested_at",)) -> DataFrame:
    """Label defaults to 0, ingest/score times default to now."""
    out = df
    if label and label in df.columns:
        out = out.withColumn(label, F.coalesce(F.col(label), F.lit(0)))
    for t in times:
        out = out.withColumn(t, F.coalesce(F.col(t), F.current_timestamp())
                             if t in df.columns else F.current_timestamp())
    return out
