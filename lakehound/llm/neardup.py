"""Op 10: near-duplicates by fast similarity sketching, banding and exact verification.

A document is the set of its five-word shingles. Rounds of hashing place every
shingle into one of T bins; a bin keeps its first round's least value, and
rounds go on (the last T of them one bin each) until every bin is filled. Equal
bins estimate the Jaccard similarity with the concentration of T permutations.
Sets that agree in a whole band of bins are candidates; links are confirmed on
the full sets.

Equal sets are one class from the start. Candidate classes that bands connect
form a group whose sets go once to the tasks that search it. A search starts
from any member and only looks at members not yet reached, so it never lists
pairs. A group beyond the size of one task is dealt into blocks, twice in
different ways; what then is still apart from its group's largest component
is compared with all of the group, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm import words as W
from lakehound.llm.components import components
from lakehound.llm.shared import saved, worker_forgets

#: 24 bands of 5 bins: at similarity 0.85 a pair shares none with probability 1e-6.
BANDS, BAND_BINS = 24, 5
BINS = BANDS * BAND_BINS
#: link if 100 * intersection >= PERCENT * union.
PERCENT = 85
#: For links from 80 percent: 35 bands of 5 bins miss a pair of similarity 0.8 with probability 1e-6.
BANDS_80 = 35
#: Shingles of the sets that one task searches at once.
TASK_SHINGLES = 1 << 19

_EMPTY = np.uint64(2**64 - 1)
_LOW = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)


def sketches(values: np.ndarray, row: np.ndarray, rows: int, bins: int = BINS) -> np.ndarray:
    """(rows, bins) of the sets given as values with their row; a row without values stays empty."""
    out = np.full(rows * bins, _EMPTY, dtype=np.uint64)
    have = np.bincount(row, minlength=rows) > 0
    for k in range(2 * bins):
        if not len(values):
            break
        h = W.mix(values + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        spot = (((h >> _S32) * np.uint64(bins)) >> _S32).astype(np.int64) if k < bins else k - bins
        np.minimum.at(out, row * bins + spot, np.uint64(k) << _S32 | (h & _LOW))
        open_ = have & (out.reshape(rows, bins) == _EMPTY).any(axis=1)
        if not open_.all():
            left = open_[row]
            values, row = values[left], row[left]
    return out.reshape(rows, bins)


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(rows, bands) keys; a key holds its band's number."""
    rows, bins = sketch.shape
    parts = sketch.reshape(rows, bands, bins // bands)
    slots = W.mix(np.arange(1, bins // bands + 1, dtype=np.uint64)) | np.uint64(1)
    return W.mix(W.mix((W.mix(parts) * slots).sum(axis=2, dtype=np.uint64)) + np.arange(bands, dtype=np.uint64))


def set_ids(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes for each set, from its size and two sums of hashed members; None for the empty set."""
    first = np.cumsum([0] + [len(s) for s in sets])
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sums = np.zeros((2, len(every) + 1), dtype=np.uint64)
    for k in (0, 1):
        np.cumsum(W.mix(every ^ np.uint64(0xA5A5A5A5 << k)), out=sums[k, 1:])
    both = sums[:, first[1:]] - sums[:, first[:-1]] + np.diff(first).astype(np.uint64)
    return [bytes(x) if len(s) else None for x, s in zip(both.T.copy(), sets, strict=True)]


def _sketched(n_bands: int):
    def sketch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_forgets()
        for column in texts:
            parts = []
            for _, text in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
                sets = W.shingle_sets(text)
                sizes = np.array([len(s) for s in sets])
                every = np.concatenate(sets)
                keys = band_keys(sketches(every, np.repeat(np.arange(len(sets)), sizes), len(sets), n_bands * BAND_BINS), n_bands)
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, (sizes > 0) * n_bands)), pa.int32()),
                                                 pa.array(keys[sizes > 0].ravel().view(np.int64)))
                parts.append(pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(set_ids(sets), pa.binary()), bands],
                                                        names=["n_shingles", "set_id", "bands"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("n_shingles", pa.int64()), ("set_id", pa.binary()), ("bands", pa.list_(pa.int64()))]))
    return sketch


def _sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        parts = []
        for _, text in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            sets = W.shingle_sets(text)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            parts.append(pa.StructArray.from_arrays([pa.array(set_ids(sets), pa.binary()), lists], names=["set_id", "shingles"]))
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("set_id", pa.binary()), ("shingles", pa.list_(pa.int64()))]))


class Postings:
    """Which of some sets hold a shingle, as flat arrays; sets can be taken out."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.values, own = np.unique(every, return_inverse=True)
        self.holder = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(own, kind="stable")
        self.holder, self._own = self.holder[order], own[order]
        self._index()

    def _index(self) -> None:
        self.first = np.searchsorted(self._own, np.arange(len(self.values) + 1))

    def keep(self, wanted: np.ndarray) -> None:
        stay = wanted[self.holder]
        self.holder, self._own = self.holder[stay], self._own[stay]
        self._index()

    def shared(self, one: np.ndarray) -> np.ndarray:
        """The intersection's size of ``one`` with every set."""
        at = np.minimum(np.searchsorted(self.values, one), len(self.values) - 1)
        at = at[self.values[at] == one]
        a, b = self.first[at], self.first[at + 1]
        n = b - a
        flat = np.repeat(a - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.bincount(self.holder[flat], minlength=len(self.sizes))

    def linked(self, one: np.ndarray, percent: int) -> np.ndarray:
        both = self.shared(one)
        return (both > 0) & (100 * both >= percent * (len(one) + self.sizes - both))


def forest(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect exactly the components of the similarity graph of ``sets``."""
    out: list[tuple[int, int]] = []
    open_ = np.ones(len(sets), dtype=bool)
    index, size = Postings(sets), len(sets)
    for start in range(len(sets)):
        if not open_[start]:
            continue
        open_[start] = False
        todo = [start]
        while todo:
            one = todo.pop()
            new = np.flatnonzero(index.linked(sets[one], percent) & open_)
            open_[new] = False
            out += [(one, int(k)) for k in new]
            todo += new.tolist()
            if 2 * open_.sum() < size:
                size = int(open_.sum())
                index.keep(open_)
            if not size:
                break
    return out


def _streams(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys of sorted batches."""
    run, last = [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        shingles = batch.column("shingles")
        ids = batch.column("set_id").to_pylist()
        own = batch.column("rest").to_pylist() if "rest" in batch.schema.names else [None] * batch.num_rows
        labels = batch.column("component").to_pylist() if "component" in batch.schema.names else ids
        flat = shingles.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        cut = shingles.offsets.to_numpy() - shingles.offsets[0].as_py()
        for i, key in enumerate(zip(*columns, strict=True)):
            if key != last and run:
                yield run
                run = []
            last = key
            run.append({"id": ids[i], "set": flat[cut[i]:cut[i + 1]].copy(), "rest": own[i], "component": labels[i]})
    if run:
        yield run


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary())], names=["u", "v"])


def _searched(percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _streams(batches, ["group", "block"]):
            if len(run) > 1:
                yield _edges([(run[a]["id"], run[b]["id"]) for a, b in forest([x["set"] for x in run], percent)])
    return search


def _compared(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _streams(batches, ["group", "rest_block", "block"]):
            rest, all_ = [x for x in run if x["rest"]], [x for x in run if not x["rest"]]
            if not rest or not all_:
                continue
            index = Postings([x["set"] for x in all_])
            pairs = {}
            for one in rest:
                for k in np.flatnonzero(index.linked(one["set"], percent)):
                    ends = (one["component"], all_[k]["component"])
                    if ends[0] != ends[1]:
                        pairs[min(ends), max(ends)] = (one["id"], all_[k]["id"])
            yield _edges(list(pairs.values()))
    return compare


def _search(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Links inside blocks; ``members`` has set_id, group, blocks, shingles. A group of one block is searched whole."""
    block = F.pmod(F.xxhash64(F.lit(turn), "set_id"), F.col("blocks"))
    dealt = members.select("set_id", "group", block.alias("block"), "shingles")
    return dealt.repartition("group", "block").sortWithinPartitions("group", "block").mapInArrow(_searched(percent), "u binary, v binary")


def _remaining(members: DataFrame, found: DataFrame, percent: int, task_shingles: int) -> DataFrame:
    """Links of dealt groups between what is apart from the largest component and all members."""
    large = members.filter("blocks > 1").join(components(found), F.col("set_id") == F.col("node"), "left").drop("node")
    large = saved(large.withColumn("component", F.coalesce("component", "set_id")), "near-large")
    sizes = large.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("s"))
    # a group's components: the largest one is found by a partial max, not by sorting them in one task
    top = sizes.groupBy("group").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("s").alias("all"), F.count(F.lit(1)).alias("parts"))
    top = top.filter("parts > 1").join(sizes.select("group", "component", F.col("s").alias("most")),
                                       ["group"]).filter(F.col("component") == F.col("top.component"))
    top = top.select("group", F.col("top.component").alias("largest"), F.ceil((F.col("all") - F.col("most")) / task_shingles).cast("long").alias("rest_blocks"))
    rows = large.join(top, "group")
    rest = rows.filter(F.col("component") != F.col("largest")).select(
        "group", "set_id", "component", "shingles", F.lit(True).alias("rest"),
        F.pmod(F.xxhash64(F.lit(8), "set_id"), F.col("rest_blocks")).alias("rest_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    every = rows.select(
        "group", "set_id", "component", "shingles", F.lit(False).alias("rest"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("rest_block"), F.pmod(F.xxhash64(F.lit(9), "set_id"), F.col("blocks")).alias("block"))
    keys = ["group", "rest_block", "block"]
    return rest.unionByName(every).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared(percent), "u binary, v binary")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, task_shingles: int = TASK_SHINGLES, bands: int = BANDS) -> DataFrame:
    """Components of near-duplicate rows of ``docs`` (doc_id, text); a smaller ``percent`` needs more ``bands``.

    Words are runs without ASCII white space, A-Z lower-cased; fewer than five words are one shingle,
    null and empty texts have none and link with nothing. component_id is the smallest doc_id of the
    rows that links reach (null ids are left out, and null where all are); kept is true for the rows
    with that doc_id. Repeated rows are equal sets, so one class. Other columns are not used.
    Returns doc_id, n_shingles, component_id, kept.
    """
    rows = docs.select("doc_id", F.arrow_udf(_sketched(bands), "struct<n_shingles: bigint, set_id: binary, bands: array<bigint>>")("text").alias("s"))
    table = saved(rows.select("doc_id", "s.*"), "near-sketches")
    classes = saved(table.filter("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")), "near-classes")
    banded = classes.select("set_id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("set_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = banded.join(shared, "band").filter(F.col("set_id") != F.col("least")).select(F.col("set_id").alias("u"), F.col("least").alias("v")).distinct()
    groups = saved(components(stars), "near-groups")
    sized = groups.join(classes.select("set_id", "n_shingles", "first_doc"), F.col("node") == F.col("set_id"))
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n_shingles") / task_shingles).cast("long").alias("blocks"))
    wanted = saved(sized.join(blocks, "component").select("set_id", "first_doc", F.col("component").alias("group"), "blocks"), "near-wanted")
    # the sets of the members only: their texts by doc_id, then by the set itself (ids may repeat or be null)
    texts = docs.select("doc_id", "text").join(wanted.select("first_doc").distinct(), F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")
    sets = texts.select(F.arrow_udf(_sets, "struct<set_id: binary, shingles: array<bigint>>")("text").alias("s")).select("s.*")
    members = saved(sets.join(wanted.select("set_id", "group", "blocks"), "set_id").dropDuplicates(["set_id"]), "near-members")
    links = _search(members, 1, percent)
    if members.filter("blocks > 1").limit(1).count():
        found = saved(links.unionByName(_search(members.filter("blocks > 1"), 2, percent)), "near-links")
        links = found.unionByName(_remaining(members, found, percent, task_shingles))
    parts = components(links)
    reached = parts.join(classes.select("set_id", "first_doc"), F.col("node") == F.col("set_id"))
    least = reached.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    moved = reached.join(least, "component").select("set_id", F.col("component_id"))
    final = classes.select("set_id", "first_doc").join(moved, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "first_doc").alias("component_id"))
    out = table.select("doc_id", "n_shingles", "set_id").join(final, "set_id", "left")
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
