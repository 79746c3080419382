"""Stored rows replayed as a stream of change events, in order of event time and in batches of bounded size."""

from __future__ import annotations

import math
import os
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakehound.session import discard, shared_dir

#: Rows of a file (about); a batch reads one file for each task the cluster runs at once.
FILE_ROWS = 100_000
#: Batches of a replay whose state and offsets are kept, for a restart.
KEPT_BATCHES = 5
#: Names the closing event, which queries leave out of their result.
END = "__end__"


def files_per_batch(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


@contextmanager
def state_by_file(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in one partition for each file of a batch.

    A partition's commit costs much the same however few rows it got, so the number follows the tasks that run at
    once, not the session's shuffle partitions. A stream that resumes keeps the number in its checkpoint.
    The state's files are packed well, and those of batches before the last KEPT_BATCHES go.
    """
    with _set(spark, {"spark.sql.shuffle.partitions": files_per_batch(spark), "spark.sql.streaming.minBatchesToRetain": KEPT_BATCHES,
                      "spark.sql.streaming.stateStore.compression.codec": "zstd"}):
        yield


@contextmanager
def _set(spark: SparkSession, settings: dict) -> Iterator[None]:
    """The session with other settings inside."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _ranges(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """Add ``slice``, the number of cuts (ascending) below ``at``, found by a binary search; 0 without a time."""
    if not cuts:
        return rows.withColumn("slice", F.lit(0))
    known = rows.withColumn("_at", F.coalesce("at", F.lit(cuts[0])).cast("double"))
    search = Bucketizer(splits=[-math.inf, *[float(c + 1) for c in cuts], math.inf], inputCol="_at", outputCol="_slice")
    return search.transform(known).withColumn("slice", F.col("_slice").cast("int")).drop("_at", "_slice")


def write_in_order(events: DataFrame, folder: str, end: str, compression: str = "none") -> None:
    """Write (value, created_at) as text files whose modification order is that of event time.

    Rows are cut into ranges of event time of FILE_ROWS times :func:`files_per_batch` rows (about;
    at least two ranges, so that a batch follows another), each written after the one before as the
    files of one batch. Rows are dealt out by a hash, so many rows of one time still make files of like size. ``end`` is
    the closing event's text, with a place for its time, a day later: it lets the watermark pass all windows.
    The files are packed by ``compression``, and each step's copy and shuffle files go when the next one stands.
    """
    with _set(events.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        _write_steps(events, folder, end, compression)


def _write_steps(events: DataFrame, folder: str, end: str, compression: str) -> None:
    spark, files = events.sparkSession, files_per_batch(events.sparkSession)
    at = F.unix_micros(F.col("created_at").cast("timestamp"))
    staged = shared_dir(spark, "staged")
    plain, sliced = os.path.join(staged, "rows"), os.path.join(staged, "slices")
    events.select("value", "created_at", at.alias("at")).write.option("compression", "zstd").parquet(plain)
    rows = spark.read.parquet(plain)
    n, last = rows.agg(F.count(F.lit(1)), F.max("created_at").cast("timestamp_ntz")).first()
    if not n:
        return
    ranges = max(2, math.ceil(n / (FILE_ROWS * files)))
    cuts = rows.select(F.percentile_approx("at", [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    file = F.pmod(F.xxhash64("value", "at"), F.lit(files)).cast("int")
    _ranges(rows, cuts).select("slice", "value", file.alias("file")).repartitionById(
        (len(cuts) + 1) * files, F.col("slice") * files + F.col("file")).write.partitionBy("slice").option("compression", "zstd").parquet(sliced)
    discard(spark, plain)
    slices = spark.read.parquet(sliced)
    # a blank line for each file, which no parser takes for an event: a range has just as many files as a batch reads
    blank = spark.range(files).select(F.lit("").alias("value"), F.col("id").cast("int").alias("file"))
    for k in range(len(cuts) + 1):  # the partition filter reads that range's rows alone
        piece = slices.filter(F.col("slice") == k).select("value", "file").unionByName(blank)
        piece.repartitionById(files, "file").select("value").write.mode("append").option("compression", compression).text(folder)
        discard(spark, os.path.join(sliced, f"slice={k}"))
    stamp = F.date_format(F.lit(last) + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss")
    spark.range(1).select(F.format_string(end, stamp).alias("value")).coalesce(1).write.mode("append").option("compression", compression).text(folder)


def finished(q: StreamingQuery) -> None:
    """Wait for the end of a replay; no row may have come too late."""
    q.awaitTermination()
    _none_late(q)


def _none_late(q: StreamingQuery) -> None:
    late = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    if late:
        raise RuntimeError(f"{late} rows came after the watermark")


def stopped_and_resumed(begin: Callable[..., StreamingQuery], batches: int = 1, wait: float = 600.0) -> None:
    """Run a query under a processing-time trigger until ``batches`` are done, stop it, and let it finish from its checkpoint.

    ``begin(**how)`` starts the query with the trigger arguments of :func:`lakehound.streaming.scorer.start`.
    """
    q = begin(trigger="0 seconds")
    until = time.monotonic() + wait
    while sum(p["numInputRows"] > 0 for p in q.recentProgress) < batches:
        if q.exception() is not None:
            raise q.exception()
        if time.monotonic() > until:
            q.stop()
            raise TimeoutError("no batch was done in time")
        time.sleep(0.2)
    q.stop()
    _none_late(q)
    finished(begin(available_now=True))
