"""Op 1: URL rules decided by Bloom filter cascades.

A cascade stores the listed keys in a first Bloom filter, the false positives
of the corpus's complete key universe in a second, the listed keys that the
second one wrongly takes in a third, and so on until none is left. For every
key of that universe the first level that rejects it tells exactly whether it
is listed; judging a url needs no join.

The keys of a url are its host and parent domains with as many labels as some
rule's host, combined with every path prefix as long as some rule's path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehound.llm.shared import saved
from lakehound.llm.words import mix

#: Largest filter bits that one pass broadcasts; a larger cascade is split by key hash into several passes.
PASS_BITS = 1 << 28
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ? # or end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All rule keys that would fit: domain suffixes of so many ``labels`` joined to path prefixes of the ``lengths``.

    A url has as many keys as there are different (labels, length) among the rules, however long its host.
    """
    parts = F.split(host, r"\.")
    n_parts = F.size(parts)
    counts = F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= n_parts)
    suffixes = F.transform(counts, lambda n: F.array_join(F.slice(parts, n_parts - n + 1, n), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))


@dataclass
class Cascade:
    """levels[i] = (bits, probes) of each shard; shards split the keys by hash."""

    shards: int = 1
    levels: list[list[tuple[np.ndarray, int]]] = field(default_factory=list)

    @property
    def bits(self) -> int:
        return sum(8 * len(f) for level in self.levels for f, _ in level)


def _probes(a: np.ndarray, b: np.ndarray, level: int, probes: int, bits: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x, y = mix(a ^ seed), mix(b ^ seed) | np.uint64(1)
    return ((x[None, :] + np.arange(probes, dtype=np.uint64)[:, None] * y[None, :]) % np.uint64(bits)).astype(np.int64)


def _passes(a: np.ndarray, b: np.ndarray, level: int, filter_: tuple[np.ndarray, int]) -> np.ndarray:
    bits, probes = filter_
    at = _probes(a, b, level, probes, 8 * len(bits))
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def member(a: np.ndarray, b: np.ndarray, levels: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Exact membership of keys of the universe, given by two 64-bit hashes, in one shard's cascade."""
    listed = np.zeros(len(a), dtype=bool)
    left = np.arange(len(a))
    for k, filter_ in enumerate(levels):
        taken = _passes(a[left], b[left], k, filter_)
        listed[left[~taken]] = k % 2 == 1
        left = left[taken]
    listed[left] = len(levels) % 2 == 1
    return listed


def _filter(keys: DataFrame, level: int, n: int, rate: float, shards: int, shard: int) -> tuple[np.ndarray, int]:
    """Bits over one shard of ``keys`` (a, b): executors set them, words of 64 bits meet by bit_or."""
    per_key = 1.45 * math.log2(1 / rate)
    words = max(1, math.ceil(max(1, n / shards * 1.1) * per_key / 64))
    probes = max(1, round(math.log2(1 / rate)))

    @F.arrow_udf("array<bigint>")
    def spots(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in (a, b))
        at = _probes(x, y, level, probes, 64 * words).T
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * probes, pa.int32()), pa.array(at.ravel(), pa.int64()))

    at = keys.filter(F.pmod("b", F.lit(shards)) == shard).select(F.explode(spots("a", "b")).alias("p"))
    got = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).collect()
    bits = np.zeros(words, dtype=np.int64)
    for w, v in got:
        bits[w] = v
    return bits.view(np.uint8), probes


def hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def build_cascade(listed: DataFrame, universe: DataFrame, pass_bits: int = PASS_BITS) -> Cascade:
    """The cascade that separates ``listed`` from the rest of ``universe`` (both one column, ``key``).

    Sets are exact: the false positives of the first level leave out the listed keys by an
    anti join here, while building; later levels re-test only the (small) sets before them.
    """
    inside = saved(listed.filter("key is not null").distinct().select("key", *hashed(F.col("key"))), "listed")
    n = inside.count()
    if not n:
        return Cascade()
    others = universe.filter("key is not null").distinct().select("key", *hashed(F.col("key")))
    total = others.count()
    first = min(0.5, max(1e-6, n / max(total, 1) / math.sqrt(2)))
    # later levels together hold less than the first, as rates from the second on are one half
    shards = max(1, math.ceil(n * 1.6 * math.log2(1 / first) / pass_bits))
    out = Cascade(shards=shards)
    encode, against, rate, size = inside, others, first, n
    while size:
        level = len(out.levels)
        out.levels.append([_filter(encode, level, size, rate, shards, s) for s in range(shards)])
        wrong = against.filter(_taken(out, level)(F.col("a"), F.col("b")))
        if level == 0:
            wrong = wrong.join(inside.select("key"), "key", "left_anti")
        wrong = saved(wrong.select("key", "a", "b"), "wrong")
        encode, against, rate, size = wrong, encode, 0.5, wrong.count()
    return out


def _numpy(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _taken(cascade: Cascade, level: int):
    """Whether one level takes a key; one shard after another, each in its own UDF argument set."""
    filters = cascade.levels[level]

    @F.arrow_udf("boolean")
    def taken(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = _numpy(a), _numpy(b)
        own = (y.view(np.int64) % len(filters))
        out = np.zeros(len(x), dtype=bool)
        for s, f in enumerate(filters):
            at = np.flatnonzero(own == s)
            out[at] = _passes(x[at], y[at], level, f)
        return pa.array(out)

    return taken


def _judge(kept, shards: int):
    @F.arrow_udf("array<boolean>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for first, second in batches:
            x, y = _numpy(first.flatten()), _numpy(second.flatten())
            out = np.zeros(len(x), dtype=bool)
            own = y.view(np.int64) % shards
            for s, levels in kept.value.items():
                at = np.flatnonzero(own == s)
                out[at] = member(x[at], y[at], levels)
            counts = np.diff(first.offsets.to_numpy())
            offsets = np.zeros(len(counts) + 1, dtype=np.int32)
            np.cumsum(counts, out=offsets[1:])
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))

    return judge


def listed_keys(df: DataFrame, keys: str, cascade: Cascade, name: str, pass_bits: int = PASS_BITS) -> DataFrame:
    """Add ``name``: for each entry of the array column ``keys`` whether it is listed.

    The shards go in groups of at most ``pass_bits`` bits, one broadcast and one UDF each.
    """
    spark = df.sparkSession
    a = F.transform(keys, lambda k: F.xxhash64(k))
    b = F.transform(keys, lambda k: F.xxhash64(F.lit("second"), k))
    per_pass = max(1, cascade.shards * pass_bits // max(1, cascade.bits))
    answer = F.transform(keys, lambda k: F.lit(False))
    for start in range(0, cascade.shards if cascade.levels else 0, per_pass):
        group = range(start, min(start + per_pass, cascade.shards))
        kept = spark.sparkContext.broadcast({s: [level[s] for level in cascade.levels] for s in group})
        answer = F.zip_with(answer, _judge(kept, cascade.shards)(a, b), lambda p, q: p | q)
    return df.withColumn(name, answer)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Verdict of every page's url.

    ``pages`` needs page_id and url; ``rules`` needs rule (host and path, e.g. ``example.com/en/``)
    and verdict (allow or block). The longest fitting rule decides, block before allow for the same
    rule string; a url that fits none gets ``default``. Null, empty or scheme-less urls have an empty
    host and path and fit no rule; very long urls cost in proportion to their length. Repeated pages are judged each; other columns are not used.
    Returns page_id, host, path, rule, verdict.
    """
    clean = rules.select("rule", F.lower("verdict").alias("verdict")).filter("rule is not null and length(rule) > 0").distinct()
    # of the rules, only how many labels and how long a path they have comes here
    of_host, of_path = F.size(F.split(F.substring_index("rule", "/", 1), r"\.")), F.length(F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1))
    sizes = clean.agg(F.array_sort(F.collect_set(of_host)).alias("labels"), F.array_sort(F.collect_set(of_path)).alias("lengths")).first()
    urls = (pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
            .withColumn("keys", url_keys(F.col("host"), F.col("path"), sizes.labels, sizes.lengths) if sizes.labels else F.array().cast("array<string>")))
    universe = urls.select(F.explode("keys").alias("key")).distinct()
    universe = saved(universe, "universe")
    out = urls
    for verdict in ("allow", "block"):
        cascade = build_cascade(clean.filter(F.col("verdict") == verdict).select(F.col("rule").alias("key")), universe)
        out = listed_keys(out, "keys", cascade, f"is_{verdict}")
    fitting = F.filter(F.transform("keys", lambda k, i: F.struct(
        F.length(k).alias("n"), F.get("is_block", i).alias("block"), F.get("is_allow", i).alias("allow"), k.alias("rule"))),
        lambda x: x.block | x.allow)
    best = F.array_max(fitting)
    return out.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), default).when(F.col("best.block"), "block").otherwise("allow").alias("verdict"))
