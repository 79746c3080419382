"""Op 9: shards by jump consistent hashing, with gapless slots.

A row's shard depends on its key and the shard count alone; one more shard
takes only the rows that move into it. Slots number a shard's rows without
bringing a shard into one task: each input partition numbers its own rows,
and the partitions' counts, summed in order, give where each one begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.llm.shared import saved


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash (Lamping and Veach) of 64-bit keys, all at once."""
    key = keys.astype(np.uint64, copy=True)
    shard = np.full(len(key), -1, dtype=np.int64)
    ahead = np.zeros(len(key), dtype=np.int64)
    moving = np.arange(len(key))
    while len(moving):
        shard[moving] = ahead[moving]
        key[moving] = key[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (shard[moving] + 1) * ((1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1))
        ahead[moving] = step.astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a long hash column."""
    @F.arrow_udf("int")
    def chosen(hashes: pa.Array) -> pa.Array:
        return pa.array(jump(hashes.to_numpy(zero_copy_only=False).view(np.uint64), shards).astype(np.int32))

    return chosen(key)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        local = np.empty(len(shard), dtype=np.int64)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            local[at] = np.arange(len(at)) + seen.get(int(s), 0)
            seen[int(s)] = seen.get(int(s), 0) + len(at)
        names = batch.schema.names + ["part", "local"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), part, np.int32)), pa.array(local)], names=names)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards of ``docs`` (doc_id, text) under the ``key`` law.

    size is the text's UTF-8 bytes plus 1 (null text: 1), text_crc32 its CRC-32 (null: 0). Rows
    with a null doc_id share one key and so one shard; repeated rows each get a slot. Other
    columns are not used. Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.
    """
    key = F.xxhash64(F.lit("shard"), F.col("doc_id"))
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
                       F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
                       shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"))
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])
    table = saved(rows.mapInArrow(_numbered, schema), "shards")
    counts = table.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return table.join(begins, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("begin") + F.col("local")).alias("slot"), "grown_shard")
