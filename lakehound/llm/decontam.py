"""Op 3: benchmark decontamination by SimHash of item-sized windows.

Texts are taken as words (ASCII punctuation and white space part them, A-Z
lower-cased). For every benchmark item, windows of the item's word count slide
over a text wherever it shares a five-word shingle with the item's benchmark
(a window without one has similarity 0). A window's 64-bit SimHash of its
weighted shingles is looked up in a multi-index of the items' fingerprints:
with eight blocks, each fingerprint within RADIUS differs by at most
RADIUS // 8 bits in some block, so all of them are found. Candidates are
verified by the exact weighted Jaccard similarity of the shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm import words as W
from lakehound.llm.shared import saved, worker_forgets

SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
#: Benchmark text that one pass over the documents takes to the tasks; a larger benchmark goes in several passes.
PASS_BYTES = 16 << 20

_BITS = np.arange(64, dtype=np.uint64)


def _words(text: W.Text) -> tuple[W.Words, np.ndarray]:
    words = W.split(text, W.IS_APART)
    return words, W.spans_hash(W.LOWER[text.data], words.starts, words.ends)


def _shingles(values: np.ndarray) -> np.ndarray:
    """In order; fewer than five words are one shingle."""
    if 0 < len(values) < W.SHINGLE_WORDS:
        return W.mix(W.windows_hash(values, len(values)) + np.uint64(len(values)))
    return W.windows_hash(values)


def _signs(shingles: np.ndarray) -> np.ndarray:
    return (((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) << 1) - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.bitwise_or.reduce((sums > 0).astype(np.uint64) << _BITS, axis=-1)


def simhash(shingles: np.ndarray) -> np.uint64:
    return _packed(_signs(shingles).sum(axis=0)[None, :])[0]


class HammingIndex:
    """All stored fingerprints within RADIUS of a query, by blocks of eight bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.lists: list[list[list[int]]] = [[[] for _ in range(256)] for _ in range(BLOCKS)]
        near = [sum(1 << b for b in flips) for k in range(radius // BLOCKS + 1) for flips in combinations(range(8), k)]
        for i, value in enumerate(prints):
            for block in range(BLOCKS):
                own = int(value) >> (8 * block) & 255
                for flip in near:
                    self.lists[block][own ^ flip].append(i)
        self.tables = [[np.array(x, dtype=np.int64) for x in block] for block in self.lists]

    def near(self, value: np.uint64) -> np.ndarray:
        found = np.unique(np.concatenate([self.tables[b][int(value) >> (8 * b) & 255] for b in range(BLOCKS)]))
        return found[np.bitwise_count(self.prints[found] ^ value) <= self.radius]


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class Benchmark:
    """Items of one pass: shingle counts, fingerprints by word count, and which shingles occur at all."""

    def __init__(self, items: list[tuple[object, str]]):
        column = pa.array([t for _, t in items], pa.string())
        text = W.flat(column)
        words, values = _words(text)
        own = [values[words.first[i]:words.first[i + 1]] for i in range(text.rows)]
        self.items = [(items[i][0], len(v), _shingles(v)) for i, v in enumerate(own) if len(v)]
        self.counts = [Counter(s.tolist()) for _, _, s in self.items]
        prints = np.array([simhash(s) for _, _, s in self.items], dtype=np.uint64)
        self.shingles = np.unique(np.concatenate([s for _, _, s in self.items])) if self.items else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.shingles >> np.uint64(44)).astype(np.int64)] = True
        #: sizes: word count -> (index of the items with it, the multi-index over them)
        self.sizes = {}
        for n in sorted({n for _, n, _ in self.items}):
            at = np.array([i for i, x in enumerate(self.items) if x[1] == n])
            self.sizes[n] = (at, HammingIndex(prints[at]))
        self.holders: dict[int, set[int]] = {}
        for i, (_, _, s) in enumerate(self.items):
            for x in s.tolist():
                self.holders.setdefault(x, set()).add(i)
        self.short = [i for i, x in enumerate(self.items) if x[1] < W.SHINGLE_WORDS]

    def _shared(self, shingles: np.ndarray) -> np.ndarray:
        """Positions whose shingle some item has."""
        at = np.flatnonzero(self.seen[(shingles >> np.uint64(44)).astype(np.int64)])
        at = at[np.isin(shingles[at], self.shingles)]
        return at

    def leaks(self, values: np.ndarray, shared: np.ndarray, shingles: np.ndarray, similarity: float) -> list[tuple[object, float, int, int]]:
        """(item_id, similarity, first word, words) of the best window of each item in one text."""
        best: dict[int, tuple[float, int, int]] = {}
        sizes: dict[int, set[int]] = {}
        for p in shared.tolist():
            for i in self.holders[int(shingles[p])]:
                sizes.setdefault(self.items[i][1], set()).add(p)
        for n, places in sizes.items():
            size = min(n, len(values))
            width = max(1, size - W.SHINGLE_WORDS + 1)
            last = max(0, len(values) - size)
            starts = np.unique(np.concatenate([np.arange(max(0, p - width + 1), min(p, last) + 1) for p in places]))
            self._windows(n, size, width, starts, shingles, best, similarity)
        return [(self.items[i][0], *x) for i, x in sorted(best.items())]

    def _windows(self, n, size, width, starts, shingles, best, similarity) -> None:
        at, index = self.sizes[n]
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for a in range(0, len(run), 4096):  # bounds the sign table of a long run
                part = run[a:a + 4096]
                total = np.zeros((len(part) + width, 64), dtype=np.int32)
                np.cumsum(_signs(shingles[part[0]:part[-1] + width]), axis=0, out=total[1:])
                prints = _packed(total[width:] - total[:-width])
                for start, value in zip(part.tolist(), prints, strict=True):
                    near = index.near(value)
                    if not len(near):
                        continue
                    own = Counter(shingles[start:start + width].tolist())
                    for i in at[near].tolist():
                        score = weighted_jaccard(own, self.counts[i])
                        if score >= similarity and (i not in best or score > best[i][0]):
                            best[i] = (score, start, size)

    def scan(self, text: W.Text, similarity: float) -> Iterator[tuple[int, object, float, int, int]]:
        words, values = _words(text)
        counts = np.diff(words.first)
        all_shingles = W.windows_hash(values)
        shared = self._shared(all_shingles)
        # a shingle must lie within one row
        row = words.row[shared] if len(shared) else np.zeros(0, np.int64)
        inside = shared + W.SHINGLE_WORDS <= words.first[row + 1]
        shared, row = shared[inside], row[inside]
        for i in np.unique(row).tolist():
            a, b = words.first[i], words.first[i + 1]
            own = all_shingles[a:b - W.SHINGLE_WORDS + 1]
            for found in self.leaks(values[a:b], shared[row == i] - a, own, similarity):
                yield (i, *found)
        for k in self.short:  # items of fewer than five words: one shingle of all of them
            n, want = self.items[k][1], self.items[k][2][0]
            runs = W.mix(W.windows_hash(values, n) + np.uint64(n))
            hits = np.flatnonzero(runs == want)
            rows = words.row[hits] if len(hits) else np.zeros(0, np.int64)
            ok = hits + n <= words.first[rows + 1]
            for i in np.unique(rows[ok]).tolist():
                yield i, self.items[k][0], 1.0, int(hits[ok][rows[ok] == i][0] - words.first[i]), n
        for i in np.flatnonzero((counts > 0) & (counts < W.SHINGLE_WORDS)).tolist() if any(n >= W.SHINGLE_WORDS for _, n, _ in self.items) else []:
            own = Counter(_shingles(values[words.first[i]:words.first[i + 1]]).tolist())
            for k, other in enumerate(self.counts):
                if self.items[k][1] >= W.SHINGLE_WORDS and weighted_jaccard(own, other) >= similarity:
                    yield i, self.items[k][0], weighted_jaccard(own, other), 0, int(counts[i])


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Benchmark items found in ``docs`` (doc_id, text); ``benchmark`` has item_id and text.

    One row per document row and item: doc_id, item_id, similarity (of the best window), start_word,
    n_words. Null and empty texts or items match nothing; a text shorter than an item is one window.
    Of windows with equal similarity the first is given. Repeated rows are searched each.
    The benchmark is split by a hash of item_id into passes of about ``pass_bytes`` text, one after another, each with a
    written result; texts are searched whole, whatever their length. Other columns are not used.
    """
    spark = docs.sparkSession
    items = benchmark.filter(F.length("text") > 0).select("item_id", "text")
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-volume // pass_bytes))
    kind = benchmark.schema["item_id"].dataType
    out = None
    for k in range(passes):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).collect()
        kept = spark.sparkContext.broadcast([(r.item_id, r.text) for r in own])
        del own
        found = _leak_column(kept, kind.simpleString(), similarity)
        rows = saved(docs.select("doc_id", F.inline(found("text"))), "leaks")
        kept.destroy()  # one pass's items at a time
        out = rows if out is None else out.unionByName(rows)
    return out


def _leak_column(kept, kind: str, similarity: float):
    fields = f"array<struct<item_id: {kind}, similarity: double, start_word: int, n_words: int>>"

    @F.arrow_udf(fields)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_forgets()
        bench = Benchmark(kept.value)
        for column in texts:
            out: list[list[dict]] = [[] for _ in range(len(column))]
            begin = 0
            for _, part in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
                for i, item, score, start, n in bench.scan(part, similarity):
                    out[begin + i].append({"item_id": item, "similarity": score, "start_word": start, "n_words": n})
                begin += part.rows
            item_type = pa.array([x[0] for x in kept.value]).type if kept.value else pa.int64()
            yield pa.array(out, pa.list_(pa.struct([("item_id", item_type), ("similarity", pa.float64()), ("start_word", pa.int32()), ("n_words", pa.int32())])))

    return found
