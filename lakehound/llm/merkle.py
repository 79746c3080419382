"""Op 12: a Merkle manifest of a table, by slot pivots.

A tree has FANOUT children a parent. Going up, the children of all parents of
a level are spread into FANOUT slot columns by conditional aggregates, grouped by
(tree, parent): concatenating the columns hashes the parent. Every level's pivot
is a written table. Going down, a child's siblings are its parent's columns
without its own slot, and its proof is these followed by its parent's proof, so
each level is one join on unique keys. A group holds FANOUT rows at most, and
no task sees a whole tree: places in the order come from a range sort and the
counts of its partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehound.llm.shared import saved

FANOUT = 3
#: The leaf's columns, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before: string, after: string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``idx``, the place of a row in its ``tree`` by ``order``, and ``n``, the tree's rows.

    Rows are range-sorted; a row's place in its partition and the counts of the partitions before
    give its place in the tree, so a large tree is spread over many tasks.
    """
    placed = saved(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                   .withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy(tree, "part").agg(F.min("place").alias("head"), F.count(F.lit(1)).alias("rows"))
    # a tree has one row here for each partition of the sort at most
    whole = Window.partitionBy(tree)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(tree, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("head")).alias("shift"),
                         F.sum("rows").over(whole).alias("n"))
    return placed.join(parts, [tree, "part"]).withColumn("idx", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _pivot(nodes: DataFrame, *values: str) -> DataFrame:
    """One row for each parent: its children's ``values`` in FANOUT slot columns each."""
    slot = F.col("idx") % FANOUT
    return nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx"), "n").agg(
        *[F.max(F.when(slot == k, F.col(c))).alias(f"{c}{k}") for c in values for k in range(FANOUT)])


def climb(nodes: DataFrame, *values: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of all levels of the trees of ``nodes`` (tree, idx, n, hash, values), and their tops (tree, hash, height).

    ``values`` go along on the lowest level only. A tree of one node is its own top.
    """
    levels: list[DataFrame] = []
    tops = [nodes.filter("n = 1").select("tree", "hash", F.lit(0).alias("height"))]
    most = nodes.agg(F.max("n")).first()[0] or 0
    carried = ("hash", *values)
    while most > 1:
        pivot = saved(_pivot(nodes.filter("n > 1"), *carried), "merkle-level")
        levels.append(pivot)
        nodes = pivot.select("tree", "idx", F.floor((F.col("n") + (FANOUT - 1)) / FANOUT).alias("n"),
                             digest(*[F.col(f"hash{k}") for k in range(FANOUT)]).alias("hash"))
        tops.append(nodes.filter("n = 1").select("tree", "hash", F.lit(len(levels)).alias("height")))
        carried = ("hash",)
        most = (most + FANOUT - 1) // FANOUT
    return levels, reduce(DataFrame.union, tops)


def descend(levels: list[DataFrame], tops: DataFrame, *values: str) -> DataFrame:
    """Nodes of the lowest level with ``path``, from the pivots and ``tops`` (tree, height, path, kept columns).

    ``path`` has a step for each level up to the root: the siblings before the node and those after
    it. Columns of ``tops`` beside height go down to every node of the tree.
    """
    kept = [c for c in tops.columns if c not in ("tree", "height", "path")]
    above = None
    for level in range(len(levels) - 1, -1, -1):
        roots = tops.filter(F.col("height") == level + 1).select("tree", F.lit(0).cast("long").alias("idx"), "path", *kept)
        above = roots if above is None else above.union(roots)
        slots = []
        own = values if level == 0 else ()
        for k in range(FANOUT):
            step = F.struct(F.concat_ws("", *[F.col(f"hash{j}") for j in range(k)]).alias("before"),
                            F.concat_ws("", *[F.col(f"hash{j}") for j in range(k + 1, FANOUT)]).alias("after"))
            slots.append(F.struct((F.col("idx") * FANOUT + k).alias("idx"), F.col(f"hash{k}").alias("hash"), step.alias("step"),
                                  *[F.col(f"{c}{k}").alias(c) for c in own]))
        children = levels[level].join(above, ["tree", "idx"]).select("tree", F.explode(F.array(*slots)).alias("child"), "path", *kept)
        above = children.filter("child.hash is not null").select(
            "tree", "child.idx", F.concat(F.array("child.step"), "path").alias("path"), *kept,
            *(["child.hash", *[f"child.{c}" for c in own]] if level == 0 else []))
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step.before, node, step.after))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step.before, step.after)), ""))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, hash and tampered of every row; ``tree`` is unique for a source and sorts as sources do, null first."""
    same = [field(F.col(c)) for c in FIELDS]
    bare = [*same[:-1], field(F.replace(F.col("text"), F.lit("\n"), F.lit("")))]
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("tree"), "doc_id",
                       digest(*same).alias("hash"), F.when(even, digest(*bare)).alias("tampered"))
    return rows.withColumn("tampered", F.coalesce("tampered", "hash"))


def manifest(docs: DataFrame) -> DataFrame:
    """Merkle manifest of ``docs`` (doc_id, source, lang, n_chars, text), with a proof of every row.

    Nulls in any field are written as ``-``; rows without a source are one tree, the first. Rows that
    repeat a doc_id stand in the order of their leaf digests and count each; a null doc_id comes first
    and is not tampered with. An empty table gives no rows. Texts are hashed whole. Other columns are
    not used. Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    nodes = saved(numbered(saved(leaves(docs), "merkle-leaves"), "tree", "doc_id", "hash"), "merkle-nodes")
    levels, tops = climb(nodes, "doc_id", "tampered")
    sources = tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "hash", "height")
    sources = saved(numbered(saved(sources, "merkle-tops"), "tree", "source"), "merkle-sources")
    upper, top = climb(sources, "source", "height")
    root = (top.first() or {"hash": None})["hash"]
    none = F.array().cast(f"array<{STEP}>")
    if upper:
        paths = descend(upper, top.select("tree", "height", none.alias("path")), "source", "height")
    else:
        paths = sources.select("source", "hash", "height", none.alias("path"))
    paths = saved(paths.select(F.col("source").alias("tree"), F.col("height").cast("int"), "path", F.col("hash").alias("subroot")), "merkle-paths")
    columns = ["doc_id", "hash", "tampered", "path", "subroot"]
    lone = nodes.filter("n = 1").join(paths.select("tree", "path", "subroot"), "tree").select(*columns)
    out = lone.union(descend(levels, paths, "doc_id", "tampered").select(*columns)) if levels else lone
    folded = fold(F.col("tampered"), F.col("path"))
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                      proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
                          "verified", F.col("folded_root") == F.col("root"))
