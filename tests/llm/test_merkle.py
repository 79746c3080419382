"""Op 12 against a Merkle tree built in plain Python."""

import hashlib
import random
import zlib

import pytest

from lakehound.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx long, path string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def _tree(nodes):
    """The root of a list of digests, and each one's (before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        nodes = [_h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def _brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    trees = {}
    for source, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[4])))
        trees[source] = (own, *_tree([_leaf(r, r[4]) for r in own]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, upper = _tree([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, upper, strict=True):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths, strict=True):
            steps = path + top
            node = _leaf(r, r[4].replace("\n", "") if r[4] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4])
            for before, after in steps:
                node = _h(before, node, after)
            out.append((r[0], _leaf(r, r[4]), subroot, root, _h(*(b + a for b, a in steps)), node, node == root))
    return sorted(out, key=str)


def _rows(n, sources):
    rnd = random.Random(n)
    return [(i if rnd.random() < 0.95 else None, rnd.choice(sources), rnd.choice(["en", None]), rnd.choice([5, None, -3]),
             rnd.choice(["a\nb", "x", "", None, "éß\n", "w " * 3000])) for i in range(n)]


@pytest.mark.parametrize("rows", [
    _rows(120, ["s1", "s1", "s1", "s1", None, "", "é", "z", "\U0001f600", "￿"]), _rows(28, ["one"]), _rows(1, [None]),
    [(1, "a", "en", 1, "t\n")] * 4 + [(2, "a", "en", 1, "t"), (2, "a", "de", 1, "t"), (3, "b", None, None, None)]])
def test_manifest(spark, rows):
    docs = spark.createDataFrame([(*r, "t", 1, "p") for r in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=str)
    assert got == _brute(rows)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
