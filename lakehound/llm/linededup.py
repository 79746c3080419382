"""Op 6: reversible line dedup with sharded cuckoo filters.

State of an index: exact postings (line key, document), the reference counts
derived from them, and per shard a cuckoo filter over the keys that are
referenced often enough. Line keys travel to their shard's filter, never a filter to
all tasks; only keys that a filter may hold meet the exact table. Filters and counts
take insertions and deletions, so taking a document out restores the state without it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm.shared import saved, worker_forgets

MIN_POINTS = 20
MIN_DOCS = 3
#: Keys that one filter shard is sized for; with twice as many on average all are dealt to new shards.
SHARD_KEYS = 1 << 17
SLOTS, LOAD, KICKS = 4, 0.85, 500
_STRIP = b" \t\n\v\f\r"


def line_key(line: bytes, min_points: int = MIN_POINTS) -> bytes | None:
    """16 bytes for a stripped, lower-cased line of enough code points, else None."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_points or (not key.isascii() and len(key.decode()) < min_points):
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, four to a bucket; keys are 16-byte digests."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16) if table is None else table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        need = max(1, int(keys / (SLOTS * LOAD)) + 1)
        return cls(1 << (need - 1).bit_length())

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """digests: (n, 2) uint64. The second place is the first xor a hash of the fingerprint."""
        mask = np.uint64(self.buckets - 1)
        print_ = (digests[:, 1] >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        one = (digests[:, 0] & mask).astype(np.int64)
        two = one ^ self._other(print_)
        return print_, one, two

    def _other(self, print_: np.ndarray) -> np.ndarray:
        return ((print_.astype(np.uint64) * np.uint64(0x5BD1E995A5A5A5A5) >> np.uint64(13)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, digests: np.ndarray) -> bool:
        """False if a key found no place after the allowed kicks; the caller then builds a larger filter."""
        for f, a, b in zip(*self._places(digests), strict=True):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = f
                    break
            else:
                at, slot = int(b), 0
                for kick in range(KICKS):
                    slot = (kick * 7 + int(f)) % SLOTS
                    f, self.table[at, slot] = self.table[at, slot], f
                    at ^= int(self._other(np.array([f], dtype=np.uint16))[0])
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = f
                        break
                else:
                    return False
        return True

    def remove(self, digests: np.ndarray) -> None:
        for f, a, b in zip(*self._places(digests), strict=True):
            for at in (a, b):
                own = np.flatnonzero(self.table[at] == f)
                if len(own):
                    self.table[at, own[0]] = 0
                    break

    def contains(self, digests: np.ndarray) -> np.ndarray:
        f, a, b = self._places(digests)
        return (self.table[a] == f[:, None]).any(axis=1) | (self.table[b] == f[:, None]).any(axis=1)


def _digests(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint64).reshape(-1, 2)


#: Rows that a task takes apart into Python lines at once.
_ROWS_AT_ONCE = 256


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for at in range(0, len(column), _ROWS_AT_ONCE):
        yield from column.slice(at, _ROWS_AT_ONCE).cast(pa.binary()).to_pylist()


def _shards(digests: np.ndarray, shards: int) -> np.ndarray:
    return ((digests[:, 0] >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _shard_column(shards: int):
    @F.arrow_udf("int")
    def of(keys: pa.Array) -> pa.Array:
        return pa.array(_shards(_digests(keys.to_pylist()), shards).astype(np.int32) if len(keys) else np.zeros(0, np.int32))

    return of


def filters_of(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, buckets, filter) over a table of distinct keys; a shard's keys are near SHARD_KEYS by design."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        digests = _digests(pdf["key"].tolist())
        made = Cuckoo.sized(len(digests))
        while not made.insert(digests):
            made = Cuckoo(made.buckets * 2)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "buckets": [made.buckets], "filter": [made.table.tobytes()]})

    return (keys.select("key", _shard_column(shards)("key").alias("shard")).groupBy("shard")
            .applyInPandas(build, "shard int, buckets long, filter binary"))


def references(postings: DataFrame) -> DataFrame:
    """The exact counts: key, refs (documents that hold it) and keeper (the largest doc_id of them)."""
    return postings.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.max("doc_id").alias("keeper"))


def postings_of(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(key, doc_id) of every line long enough, once a row. Rows without doc_id have none."""
    @F.arrow_udf("array<binary>")
    def keys(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_forgets()
        for column in texts:
            out = []
            for text in _texts(column):
                own = {line_key(x, min_points) for x in (text or b"").split(b"\n")}
                out.append(sorted(own - {None}))
            yield pa.array(out, pa.list_(pa.binary()))

    return docs.filter("doc_id is not null").select("doc_id", F.explode(keys("text")).alias("key")).select("key", "doc_id")


@dataclass
class LineIndex:
    """Postings, reference counts and filters of the documents seen so far."""

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_points: int = MIN_POINTS
    min_docs: int = MIN_DOCS

    @classmethod
    def build(cls, docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> LineIndex:
        return cls._of(postings_of(docs, min_points), min_points, min_docs)

    @classmethod
    def _of(cls, postings: DataFrame, min_points: int, min_docs: int, lasting: bool = False) -> LineIndex:
        if lasting:
            postings = saved(postings.distinct(), "postings")
        # only keys that a filter can hold need to stay for lookups
        counts = saved(references(postings).filter(F.col("refs") >= min_docs), "line-counts")
        n = counts.count()
        shards = max(1, -(-n // SHARD_KEYS))
        return cls(postings, counts, saved(filters_of(counts, shards), "line-filters"), shards, min_points, min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with ``docs`` too. Counts change only for their keys; filters take the keys that reached the limit."""
        return self._changed(saved(self.postings.unionByName(postings_of(docs, self.min_points)).distinct(), "postings"),
                             postings_of(docs, self.min_points).select("key").distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of ``doc_ids`` (doc_id); equal to one that never saw them."""
        ids = doc_ids.select("doc_id").distinct()
        touched = self.postings.join(ids, "doc_id", "left_semi").select("key").distinct()
        return self._changed(saved(self.postings.join(ids, "doc_id", "left_anti").distinct(), "postings"), saved(touched, "touched"))

    def _changed(self, postings: DataFrame, touched: DataFrame) -> LineIndex:
        fresh = references(postings.join(touched, "key", "left_semi")).filter(F.col("refs") >= self.min_docs)
        counts = saved(self.counts.join(touched, "key", "left_anti").unionByName(fresh), "line-counts")
        old, new = self.counts.select("key"), counts.select("key")
        moves = (new.join(old, "key", "left_anti").withColumn("add", F.lit(True))
                 .unionByName(old.join(new, "key", "left_anti").withColumn("add", F.lit(False))))
        moves = moves.select("key", "add", _shard_column(self.shards)("key").alias("shard"))

        def change(filters: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
            shard = int((filters if len(filters) else moved)["shard"].iloc[0])
            own = (Cuckoo(int(filters["buckets"].iloc[0]), np.frombuffer(filters["filter"].iloc[0], np.uint16).reshape(-1, SLOTS).copy())
                   if len(filters) else Cuckoo.sized(len(moved)))
            gone, more = (_digests(moved.loc[moved["add"] == x, "key"].tolist()) if len(moved) else np.zeros((0, 2), np.uint64) for x in (False, True))
            own.remove(gone)
            full = not own.insert(more)
            return pd.DataFrame({"shard": [shard], "buckets": [own.buckets], "filter": [own.table.tobytes()], "full": [full]})

        done = saved(self.filters.groupBy("shard").cogroup(moves.groupBy("shard"))
                     .applyInPandas(change, "shard int, buckets long, filter binary, full boolean"), "line-filters")
        out = LineIndex(postings, counts, done.drop("full"), self.shards, self.min_points, self.min_docs)
        n = counts.count()
        if n > 2 * self.shards * SHARD_KEYS or done.filter("full").limit(1).count():
            out.shards = max(1, -(-n // SHARD_KEYS))
            out.filters = saved(filters_of(counts, out.shards), "line-filters")
        return out

    def held(self, postings: DataFrame) -> DataFrame:
        """The (key, doc_id) of ``postings`` that a filter may hold: all that are in the counts, and few others.

        Keys go to their shard; a shard's keys are dealt over several tasks by doc_id, each with a copy of
        that one filter, so neither a common line nor a shard with many lines meets in one task.
        """
        spark = postings.sparkSession
        slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // self.shards)
        own = F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int")
        none = [F.lit(None).cast(t).alias(c) for c, t in (("buckets", "long"), ("filter", "binary"))]
        keys = postings.select(_shard_column(self.shards)("key").alias("shard"), own.alias("slice"), F.lit(1).alias("kind"), "key", "doc_id", *none)
        kind = postings.schema["doc_id"].dataType
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"),
                                      F.lit(None).cast("binary").alias("key"), F.lit(None).cast(kind).alias("doc_id"), "buckets", "filter")
        place = ["shard", "slice", "kind"]
        both = keys.unionByName(filters).repartition("shard", "slice").sortWithinPartitions(*place)
        return both.mapInArrow(_held, postings.select("key", "doc_id").schema)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that the filter before them may hold; rows come by shard and slice, the filter first."""
    at, table = None, None
    for batch in batches:
        place = np.stack([batch.column(c).to_numpy() for c in ("shard", "slice")])
        kind = batch.column("kind").to_numpy()
        heads = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0) | (kind[1:] != kind[:-1]))) if batch.num_rows else []
        passed = np.zeros(batch.num_rows, dtype=bool)
        for i, j in zip(heads, [*heads[1:], batch.num_rows], strict=True):
            if kind[i] == 0:
                at = tuple(place[:, i])
                table = Cuckoo(batch.column("buckets")[int(i)].as_py(), np.frombuffer(batch.column("filter")[int(i)].as_py(), np.uint16).reshape(-1, SLOTS))
            elif at == tuple(place[:, i]):  # a shard without a filter holds nothing
                passed[i:j] = table.contains(_digests(batch.column("key").slice(int(i), int(j - i)).to_pylist()))
        yield batch.select(["key", "doc_id"]).filter(pa.array(passed))


def _rewritten(min_points: int):
    @F.arrow_udf("struct<text: string, n_dropped: bigint>")
    def rewrite(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        worker_forgets()
        for texts, drops in batches:
            out, counts = [], []
            for text, gone in zip(_texts(texts), drops.to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                dead = set(gone or ())
                stay = [x for x in lines if line_key(x, min_points) not in dead] if dead else lines
                out.append(b"\n".join(stay))
                counts.append(len(lines) - len(stay))
            yield pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["text", "n_dropped"])

    return rewrite


def dedup_lines(docs: DataFrame, index: LineIndex | None = None, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with repeated lines dropped from text, and n_lines (before) and n_dropped added.

    A line's key is the line stripped of ASCII white space, A-Z in lower case; keys of at least
    ``min_points`` code points in at least ``min_docs`` documents stay only in the largest doc_id that
    holds them. Null texts count as one empty line and become empty. Rows with a null doc_id keep all
    lines and count for none; rows that repeat a doc_id count as one document. All other columns
    stay, whatever their names (columns named n_lines or n_dropped are replaced). Texts are taken
    apart and put together whole.
    """
    index = index or LineIndex.build(docs, min_points, min_docs)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # the keys that a filter may hold, against the exact reference counts
    lost = (index.held(postings_of(docs.select("doc_id", "text"), index.min_points)).join(index.counts, "key")
            .filter(F.col("doc_id") != F.col("keeper")).groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("key").alias("gone")))
    # the input's other columns travel in one struct, so no name of theirs can meet one of ours
    rest = F.struct(*[F.col(c) for c in names if c != "text"]).alias("rest")
    rows = docs.select(rest, F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("body"))
    both = rows.join(lost, "id", "left").withColumn("new", _rewritten(index.min_points)("body", "gone"))
    n_lines = F.length("body") - F.length(F.replace("body", F.lit("\n"))) + F.lit(1).cast("long")
    return both.select(*[F.col("new.text").alias("text") if c == "text" else F.col("rest")[c].alias(c) for c in names],
                       n_lines.alias("n_lines"), F.col("new.n_dropped").alias("n_dropped"))


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text's SHA-256."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
