"""A versioned-row table kept as one row per key, merged incrementally.

Changes are appended as batches. ``fold`` merges the batches that the snapshot does not hold yet:
only the time ranges (months by default) that lose or gain a row are written anew, all others are
taken over by reference. A manifest lists for each range the generation that holds it, its rows and
its newest time; a pointer names the manifest in force (:mod:`lakehound.sources.versions`), so readers see a whole
snapshot, old or new. The manifest also lists the batches it holds: of two folds at once one is in
force, and what only the other one held is folded next.

    {root}/changes/{batch}/            change rows
    {root}/data/gen={id}/range=.../    rows, one per key
    {root}/manifests/, {root}/batches/ published with the pointer
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.operators.dedup import latest_by_key
from lakehound.session import saved
from lakehound.sources.versions import POINTER, append_entry, newest, read_log, read_or_empty

NO_TIME = "none"
#: Keys of a batch whose hashes (8 bytes each) go to all tasks; a larger batch is joined by a shuffle.
MOST_KEYS = 2 ** 21
#: Files a range (on average) from which on a fold writes them together.
MOST_FILES = 16
_MANIFEST = T.StructType([T.StructField("range", T.StringType()), T.StructField("gen", T.StringType()),
                          T.StructField("rows", T.LongType()), T.StructField("newest", T.TimestampType())])
_BATCHES = T.StructType([T.StructField("batch", T.StringType())])


@dataclass(frozen=True)
class Snapshot:
    """A snapshot table: its place, keys, order (newest first, total) and time column."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[Column, ...]
    time: str
    grain: str = "yyyy-MM"

    def _at(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def range_of(self, time: Column) -> Column:
        """The range that a time falls into; rows without a time have one of their own."""
        return F.coalesce(F.date_format(time, self.grain), F.lit(NO_TIME))

    def append(self, rows: DataFrame, batch: str | None = None) -> str:
        """Add a batch of change rows; a batch that is sent again under its name replaces itself."""
        batch = batch or uuid.uuid4().hex
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._at("changes", batch))
        return batch

    def _manifest(self) -> tuple[DataFrame, DataFrame]:
        """Ranges and batches of the snapshot in force."""
        name = read_log(self.spark, self._at("pointer"), POINTER).agg(newest("path")).first()[0]
        if name is None:
            return self.spark.createDataFrame([], _MANIFEST), self.spark.createDataFrame([], _BATCHES)
        return (self.spark.read.schema(_MANIFEST).parquet(self._at("manifests", name)),
                self.spark.read.schema(_BATCHES).parquet(self._at("batches", name)))

    def ranges(self) -> DataFrame:
        """The rows in force with their ``range``, a partition column."""
        listed = self._manifest()[0].select("range", "gen").collect()  # one row a range of time
        named = T.StructType([*self.schema.fields, T.StructField("gen", T.StringType()), T.StructField("range", T.StringType())])
        if not listed:
            return self.spark.createDataFrame([], named).drop("gen")
        paths = [self._at("data", f"gen={r.gen}", f"range={r.range}") for r in listed]
        return self.spark.read.schema(named).option("basePath", self._at("data")).parquet(*paths).drop("gen")

    def read(self, since: dt.datetime | None = None) -> DataFrame:
        """The rows in force; with ``since`` those of the ranges from it on, by partition pruning.

        Filter the time column too where the range is wider than the window asked for.
        """
        rows = self.ranges()
        if since is not None:
            rows = rows.filter((F.col("range") >= self.range_of(F.lit(since))) & (F.col("range") != NO_TIME))
        return rows.select(*self.schema.fieldNames())

    def newest(self, n: int) -> DataFrame:
        """The rows of the newest ranges that together hold at least ``n`` rows (all rows if there are fewer)."""
        first, have = None, 0
        for r in sorted(self._manifest()[0].filter(F.col("range") != NO_TIME).collect(), key=lambda r: r.range, reverse=True):
            first, have = r.range, have + r.rows
            if have >= n:
                return self.ranges().filter((F.col("range") >= first) & (F.col("range") != NO_TIME)).select(*self.schema.fieldNames())
        return self.read()

    def as_of(self) -> dt.datetime | None:
        """The newest time of any row, from the manifest alone."""
        return self._manifest()[0].agg(F.max("newest")).first()[0]

    def fold(self) -> str | None:
        """Merge all batches that the snapshot does not hold yet; None if there are none."""
        manifest, held = self._manifest()
        names = {r.batch for r in self._written().collect()} - {r.batch for r in held.collect()}
        if not names:
            return None
        gen = f"g{uuid.uuid4().hex}"
        changes = self.spark.read.schema(self.schema).parquet(*[self._at("changes", b) for b in sorted(names)])
        new = latest_by_key(changes, self.keys, list(self.order))
        place = self.range_of(F.col(self.time)).alias("range")
        if manifest.isEmpty():
            # adaptive execution splits a range that is large and puts small ones together: few files, no task with a whole range
            rows, touched = new.select(*self.schema.fieldNames(), place).hint("rebalance", "range"), []
        else:
            old, new = self.ranges(), saved(new.select(*self.schema.fieldNames()), "batch")
            near, far = self._dealt(old, new)
            # the stored rows of changed keys, wherever they lie
            hit = near.join(new.select(*self.keys), list(self.keys), "left_semi")
            merged = latest_by_key(new.unionByName(hit.drop("range")), self.keys, list(self.order))
            # written once: its ranges decide what is read, then its rows go there
            merged = saved(merged.select(*self.schema.fieldNames(), place), "merged")
            touched = [r.range for r in hit.select("range").union(merged.select("range")).distinct().collect()]  # ranges of time
            kept = near.filter(F.col("range").isin(touched)).join(merged.select(*self.keys), list(self.keys), "left_anti").select(*merged.columns)
            if far is not None:
                kept = kept.unionByName(far.filter(F.col("range").isin(touched)).select(*merged.columns))
            if far is not None and len(old.inputFiles()) <= MOST_FILES * manifest.count():
                # stored files hold a range each and are copied without their changed keys; only the batch moves
                rows = kept.unionByName(merged.hint("rebalance", "range"))
            else:
                rows = kept.unionByName(merged).hint("rebalance", "range")
        rows.write.partitionBy("range").parquet(self._at("data", f"gen={gen}"))
        fresh = self.spark.read.schema(rows.schema).parquet(self._at("data", f"gen={gen}"))
        stats = fresh.groupBy("range").agg(F.lit(gen).alias("gen"), F.count(F.lit(1)).alias("rows"), F.max(F.col(self.time).cast("timestamp")).alias("newest"))
        manifest.filter(~F.col("range").isin(touched)).unionByName(stats).coalesce(1).write.parquet(self._at("manifests", gen))
        held.unionByName(self.spark.createDataFrame([(b,) for b in sorted(names)], _BATCHES)).coalesce(1).write.parquet(self._at("batches", gen))
        append_entry(self.spark, self._at("pointer"), POINTER, path=gen)
        return gen

    def _dealt(self, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The stored rows that may have a key of ``new``, and those that surely have none, neither moved.

        Told by the keys' hashes, which go to all tasks; a batch of more than MOST_KEYS keys may have any row's.
        """
        if new.count() > MOST_KEYS:
            return old, None
        hashed = F.xxhash64(*self.keys).alias("_hash")
        hashes, rows = F.broadcast(new.select(hashed)), old.select("*", hashed)
        return saved(rows.join(hashes, "_hash", "left_semi").drop("_hash"), "near"), rows.join(hashes, "_hash", "left_anti").drop("_hash")

    def _written(self) -> DataFrame:
        """Names of all batches that are there as a whole."""
        files = read_or_empty(self.spark, self._at("changes", "*"), self.schema)
        # paths are made distinct before they are taken apart: a file's rows share one
        return files.select("_metadata.file_path").distinct().select(F.element_at(F.split("file_path", "/"), -2).alias("batch")).distinct() if files.inputFiles() \
            else self.spark.createDataFrame([], _BATCHES)


def snapshot(spark: SparkSession, root: str, like: DataFrame, keys: Sequence[str], order: Sequence[Column], time: str,
             grain: str = "yyyy-MM") -> Snapshot:
    """The snapshot table at ``root`` of rows like ``like``."""
    return Snapshot(spark, root, like.schema, tuple(keys), tuple(order), time, grain)
