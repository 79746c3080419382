"""Op 11: token alignment of two tokenizers, by an associative fragment monoid.

Texts over ``chunk_bytes`` are cut into byte ranges. Both tokenizers surely cut
before a blank that follows no blank and precedes a letter or sign, so a range
yields an open prefix (up to its first sure cut), closed sections and an open
suffix. Two neighbouring fragments compose to one: the left one's suffix and the
right one's prefix close a joint, or grow an open end where a range holds no sure
cut. A tree of such reductions, ``fan`` fragments a step, closes a long text without
bringing it into one task; sections and joints are aligned wherever they lie.
Shorter texts are one range with both ends closed.

Groups lie between sure cuts, so a worker remembers the groups and links of the
pieces it has met. Pair counts do not travel with every link: a block of texts
sends its different pairs, gets their counts back, and sums them by document.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from lakehound.llm import words as W
from lakehound.llm.pieces import Cache
from lakehound.llm.shared import saved, worker_keeps

#: Bytes of a range, fragments that one reduction composes, bytes of text in a block.
CHUNK_BYTES, FAN, BLOCK_BYTES = 1 << 16, 16, 8 << 20
#: Different pieces that a worker remembers.
CACHE_PIECES = 200_000
#: Pieces encoded as one text, and such texts at once.
_JOINED, _AT_ONCE = 32, 256

#: Bytes after a blank that surely begin no white space.
_SURE = np.ones(256, dtype=bool)
_SURE[:33] = False
_SURE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False

EDGES = "row long, chunk long, chunks long, cut boolean, prefix binary, suffix binary, seam long"


def sure_cuts(data: np.ndarray) -> np.ndarray:
    """Places before which both tokenizers cut, whatever stands further away."""
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero((data[1:-1] == 32) & (data[:-2] != 32) & _SURE[data[2:]]) + 1


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their ids, and the pieces met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_of_letter()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names]
        size = self.b.vocab_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(size))]
        self.len_a, self.len_b = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = ([str(i) for i in range(len(v))] for v in (self.bytes_a, self.bytes_b))
        self.cache = Cache(CACHE_PIECES, {"pairs": np.uint64}, ("n_a", "n_b", "n_groups", "ok"))

    def _told(self, joined: list[bytes]) -> list[tuple[list[int], list[int]] | None]:
        """Both tokenizers' ids of texts that begin with a blank; None where either's bytes are others."""
        strings = [x.decode() for x in joined]
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        b = self.b.encode([x[1:] for x in strings], num_threads=1)
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        return [(x, y) if b"".join(map(of_a, x)) == t and b"".join(map(of_b, y)) == t else None for x, y, t in zip(a, b, joined, strict=True)]

    def _encoded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of both tokenizers over the pieces ``texts`` in order, and which pieces are told right; the others have none.

        Pieces are encoded _JOINED at a time, as far as both tokenizers surely cut between them.
        """
        own = [0]
        for k in range(1, len(texts)):
            if k - own[-1] >= _JOINED or texts[k - 1][-1] == 32 or not _SURE[texts[k][1]]:
                own.append(k)
        own.append(len(texts))
        ids_a, ids_b, ok = [], [], np.ones(len(texts), dtype=bool)
        for c in range(0, len(own) - 1, _AT_ONCE):
            spans = list(zip(own[c:c + _AT_ONCE], own[c + 1:c + _AT_ONCE + 1]))
            for (i, j), ids in zip(spans, self._told([b"".join(texts[i:j]) for i, j in spans]), strict=True):
                for k, one in ([(i, ids)] if ids else zip(range(i, j), self._told(texts[i:j]), strict=True)):
                    if one:
                        ids_a += one[0]
                        ids_b += one[1]
                    else:
                        ok[k] = False
        return np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64), ok

    def _learnt(self, texts: list[bytes]) -> tuple[dict, dict, list]:
        ids_a, ids_b, ok = self._encoded(texts)
        # places in the run of all pieces that are told right: equal for both
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        starts_a, starts_b = ends_a - self.len_a[ids_a], ends_b - self.len_b[ids_b]
        bounds = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) * ok))
        first_a, first_b = (np.searchsorted(x, bounds, side="right") for x in (ends_a, ends_b))
        n_a, n_b = np.diff(first_a), np.diff(first_b)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        left = np.searchsorted(ends_b, starts_a, side="right")
        links = np.searchsorted(starts_b, ends_a, side="left") - left
        begin = np.cumsum(links) - links
        other = np.repeat(left - begin, links) + np.arange(int(links.sum()))
        pairs = np.repeat(ids_a, links).astype(np.uint64) << np.uint64(32) | ids_b[other].astype(np.uint64)
        links_before = np.append(0, np.cumsum(links))
        n_pairs = np.diff(links_before[first_a])
        # the groups as text, and those of each piece
        to_a, to_b = (np.searchsorted(x, cuts, side="right").tolist() for x in (ends_a, ends_b))
        names_a, names_b = ([names[i] for i in ids.tolist()] for names, ids in ((self.name_a, ids_a), (self.name_b, ids_b)))
        groups, i, j = [], 0, 0
        for p, q in zip(to_a, to_b, strict=True):
            groups.append(f"{names_a[i] if p == i + 1 else ','.join(names_a[i:p])}|{names_b[j] if q == j + 1 else ','.join(names_b[j:q])}")
            i, j = p, q
        of_piece = np.searchsorted(cuts, bounds, side="right")
        n_groups, at = np.diff(of_piece), of_piece.tolist()
        written = [";".join(groups[i:j]).encode() for i, j in zip(at[:-1], at[1:], strict=True)]
        return {"pairs": (n_pairs, pairs)}, {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "ok": ok.astype(np.int64)}, written

    def aligned(self, text: W.Text) -> dict:
        """Of every row of sections: counts, groups as text, and its links' pairs; rows with an untrue piece are not ok and have none."""
        data, n = text.data, len(text.data)
        start = np.zeros(n + 1, dtype=bool)
        start[sure_cuts(data)] = True
        start[text.offsets] = True
        starts = np.flatnonzero(start[:n])
        ends = np.append(starts[1:], n)
        keys = W.spans_hash(data, starts, ends)
        different, where, back = np.unique(keys, return_index=True, return_inverse=True)
        raw = data.tobytes()
        at = self.cache.places(different, lambda new: self._learnt([raw[i:j] for i, j in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)]))
        slots = at[back]
        first = np.searchsorted(starts, text.offsets)
        pairs, begin = self.cache.runs("pairs", slots)
        ok = _sums(1 - self.cache.column("ok", slots), first) == 0
        out = {c: np.where(ok, _sums(self.cache.column(c, slots), first), 0) for c in ("n_a", "n_b", "n_groups")}
        n_links = np.diff(begin[first])
        row = np.repeat(np.arange(text.rows), n_links)
        keep = ok[row]
        known, listed, bounds = self.cache.objects, slots.tolist(), first.tolist()
        groups = [b";".join([known[s] for s in listed[i:j]]) if o else b"" for i, j, o in zip(bounds[:-1], bounds[1:], ok.tolist(), strict=True)]
        return out | {"ok": ok, "n_links": np.where(ok, n_links, 0), "groups": groups, "row": row[keep], "pairs": pairs[keep]}


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[first[1:]] - total[first[:-1]]


def _narrow(values: np.ndarray, *kinds: str) -> bytes:
    """In the first of the ``kinds`` that holds them all."""
    most = int(values.max(initial=0))
    return values.astype(next(k for k in kinds if most < 1 << 8 * int(k[-1]))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _block(number: int, held: list[tuple[pa.RecordBatch, dict]], schema: pa.Schema) -> pa.RecordBatch:
    """The rows of a block, and last its different pairs with the number of whole texts that hold each."""
    rows = pa.Table.from_batches([b for b, _ in held]).combine_chunks()
    sizes = [b.num_rows for b, _ in held]
    shift = np.repeat(np.cumsum(sizes) - sizes, [len(f["row"]) for _, f in held])
    row = np.concatenate([f["row"] for _, f in held]) + shift
    pairs, spot = np.unique(np.concatenate([f["pairs"] for _, f in held]), return_inverse=True)
    n = rows.num_rows
    each, times = np.unique(row * max(len(pairs), 1) + spot, return_counts=True)
    row, spot = each // max(len(pairs), 1), each % max(len(pairs), 1)
    first = np.searchsorted(row, np.arange(n + 1))
    part = rows.column("row").combine_chunks() if n else pa.array([], pa.int64())
    whole = part.is_null().to_numpy(zero_copy_only=False)
    holders = np.bincount(spot[whole[row]], minlength=len(pairs))
    ends = first.tolist()
    spans = list(zip(ends[:-1], ends[1:], strict=True))
    groups = [g for _, f in held for g in f["groups"]]
    ok = np.concatenate([f["ok"] for _, f in held])
    has = [f["n_a"] for _, f in held]
    empty = np.concatenate(has) == 0
    sha = [("" if e else hashlib.sha256(g).hexdigest()) if w else None for g, w, e in zip(groups, whole.tolist(), empty.tolist(), strict=True)]
    columns = {
        "block": np.full(n, number), "doc_id": rows.column("doc_id"), "row": part, "part": rows.column("part"), "ok": ok,
        **{c: np.concatenate([f[c] for _, f in held]) for c in ("n_a", "n_b", "n_groups", "n_links")}, "sha": sha,
        "groups": [None if w else g for g, w in zip(groups, whole.tolist(), strict=True)],
        "own": [None if w else pairs[spot[i:j]].tobytes() for (i, j), w in zip(spans, whole.tolist(), strict=True)],
        "n_pairs": np.diff(first), "at": [_narrow(np.diff(spot[i:j], prepend=0), "<u2", "<u4") for i, j in spans],
        "times": [_narrow(times[i:j], "<u1", "<u4") for i, j in spans], "pairs": [None] * n, "holders": [None] * n}
    last = {"block": number, "pairs": pairs.tobytes(), "holders": holders.astype("<u4").tobytes()}
    arrays = []
    for f in schema:
        column = columns[f.name]
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column if isinstance(column, pa.Array) else pa.array(column, f.type)
        arrays.append(pa.concat_arrays([column.cast(f.type), pa.array([last.get(f.name)], f.type)]))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _blocks(path_a: str, path_b: str, schema: pa.Schema):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_keeps(("alignment", path_a, path_b), lambda: Aligner(path_a, path_b))
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch, text in W.slices(batches, "data"):
            held.append((batch.drop_columns(["data"]), own.aligned(text)))
            size += len(text.data)
            if size > BLOCK_BYTES:
                yield _block(number, held, schema)
                held, size, number = [], 0, number + 1
        if held:
            yield _block(number, held, schema)
    return blocks


def _fragments(chunk_bytes: int):
    """Byte ranges of long texts: the closed sections of each, and its open ends."""
    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("data"), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                n = -(-len(data) // chunk_bytes)
                for k in range(n):
                    part = data[k * chunk_bytes:(k + 1) * chunk_bytes]
                    cuts = sure_cuts(part)
                    if k == 0:
                        cuts = np.append(0, cuts)  # a text's ends are cuts
                    if k == n - 1:
                        cuts = np.append(cuts, len(part))
                    first, last = (int(cuts[0]), int(cuts[-1])) if len(cuts) else (len(part), len(part))
                    pieces = (part[:first].tobytes(), part[first:last].tobytes(), part[last:].tobytes())
                    yield pa.RecordBatch.from_pydict({"row": [row], "chunk": [k], "chunks": [n], "cut": [len(cuts) > 0], "prefix": [pieces[0]],
                                                      "suffix": [pieces[2]], "seam": [2 * k + 1], "closed": [pieces[1]]})
    return fragments


def compose(fragments: list[tuple[bool, bytes, bytes, int]]) -> tuple[tuple[bool, bytes, bytes, int], list[tuple[int, bytes]]]:
    """One fragment (cut, prefix, suffix, seam) of neighbours in order, and the joints (seam, bytes) closed between them.

    A fragment without a cut is open as a whole: its bytes are its prefix. ``seam`` tells where a joint
    that begins at the fragment's last cut belongs. Composing is associative.
    """
    cut, prefix, suffix, seam = False, [], [], 0
    joints = []
    for has, before, after, place in fragments:
        (suffix if cut else prefix).append(before)
        if has:
            if cut:
                joints.append((seam, b"".join(suffix)))
            cut, suffix, seam = True, [after], place
    return (cut, b"".join(prefix), b"".join(suffix), seam), joints


def _composed(fan: int):
    def composed(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["chunk"])
        (cut, prefix, suffix, seam), joints = compose([(r["cut"], r["prefix"], r["suffix"], r["seam"]) for r in rows])
        row, chunk, chunks = rows[0]["row"], rows[0]["chunk"] // fan, -(-rows[0]["chunks"] // fan)
        out = {"row": [row], "chunk": [chunk], "chunks": [chunks], "cut": [cut], "prefix": [prefix], "suffix": [suffix], "seam": [seam], "closed": [None]}
        for place, data in joints:
            for k, v in {"row": row, "chunk": None, "chunks": None, "cut": None, "prefix": None, "suffix": None, "seam": place, "closed": data}.items():
                out[k].append(v)
        kinds = {"row": pa.int64(), "chunk": pa.int64(), "chunks": pa.int64(), "cut": pa.bool_(), "prefix": pa.binary(), "suffix": pa.binary(),
                 "seam": pa.int64(), "closed": pa.binary()}
        return pa.table({k: pa.array(out[k], t) for k, t in kinds.items()})
    return composed


def sections(long: DataFrame, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """(row, part, data): the closed sections and joints of ``long`` (row, data), in order of part; together they are the text."""
    table = saved(long.mapInArrow(_fragments(chunk_bytes), EDGES + ", closed binary"), "alignment-fragments")
    parts = [table.select("row", (F.col("chunk") * 2).alias("part"), "closed")]
    most = table.agg(F.max("chunks")).first()[0] or 0
    edges = table.drop("closed")
    while most > 1:
        step = saved(edges.groupBy("row", F.floor(F.col("chunk") / fan).alias("up")).applyInArrow(_composed(fan), EDGES + ", closed binary"), "alignment-joints")
        parts.append(step.filter("chunk is null").select("row", F.col("seam").alias("part"), "closed"))
        edges = step.filter("chunk is not null").drop("closed")
        most = -(-most // fan)
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return every.filter(F.length("closed") > 0).select("row", "part", F.col("closed").cast("string").alias("data"))


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, holders in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "holders")), strict=True):
            pair = np.frombuffer(pairs, np.int64)
            for k in range(0, len(pair), 1 << 16):
                own = pair[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own), pa.array(
                    np.frombuffer(holders, "<u4")[k:k + (1 << 16)].astype(np.int64))], names=["block", "pair", "holders"])


def _flat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, own in zip(batch.column("row").to_pylist(), batch.column("own").to_pylist(), strict=True):
            pair = np.frombuffer(own, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), row)), pa.array(pair)], names=["row", "pair"])


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _summed(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's rows with n_best and count_sum, from the counts of its pairs."""
    order = np.argsort(counts.column("pair").to_numpy().view(np.uint64))
    count, best = counts.column("count").to_numpy()[order], counts.column("best").to_numpy()[order]
    n_best, total = [], []
    for n, at, times in zip(*(rows.column(c).to_pylist() for c in ("n_pairs", "at", "times")), strict=True):
        spot, often = np.cumsum(_wide(at, n)), _wide(times, n)
        n_best.append(int((best[spot] * often).sum()))
        total.append(int((count[spot] * often).sum()))
    kept = rows.select(["doc_id", "row", "ok", "n_a", "n_b", "n_groups", "n_links", "sha"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the groups of each row's parts, which come one after another."""
    last, sha = None, None
    for batch in batches:
        for row, groups in zip(batch.column("row").to_pylist(), batch.column("groups"), strict=True):
            if sha is None or row != last:
                if sha is not None:
                    yield pa.RecordBatch.from_pydict({"row": [last], "sha": [sha.hexdigest()]})
                last, sha = row, hashlib.sha256()
            else:
                sha.update(b";")
            sha.update(groups.as_buffer())
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"row": [last], "sha": [sha.hexdigest()]})


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """Alignment of both tokenizers' tokens over every row of ``docs`` (doc_id, text).

    ``path_a`` is a byte-level BPE file of the tokenizers library, ``path_b`` a sentencepiece model,
    at the same place on every executor. Null and empty texts, and texts whose tokens of either
    tokenizer are not the text's bytes after a blank, have no tokens: zeros and an empty digest.
    A row is a document: rows that repeat a doc_id count each for a pair's count, also with a null
    doc_id. Texts of any length are aligned whole; only a run without a sure cut (no blank between
    letters or signs) is encoded in one piece. Other columns are not used.
    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    """
    rows = docs.select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    spaced = F.when(size > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("").alias("data")
    none = F.lit(None).cast("long")
    units = rows.filter(size <= chunk_bytes).select("doc_id", none.alias("row"), F.lit(0).cast("long").alias("part"), spaced)
    long = saved(rows.filter(size > chunk_bytes).select(F.monotonically_increasing_id().alias("row"), "doc_id", spaced), "alignment-long")
    some = not long.isEmpty()
    if some:
        parts = sections(long.select("row", F.col("data").cast("binary").alias("data")), chunk_bytes, fan)
        parts = parts.join(long.select("row", "doc_id"), "row").repartition("row", "part")
        units = units.union(parts.select("doc_id", "row", "part", "data"))
    bytes_, longs = T.BinaryType(), T.LongType()
    schema = T.StructType([T.StructField(n, k) for n, k in (
        ("block", longs), ("doc_id", rows.schema["doc_id"].dataType), ("row", longs), ("part", longs), ("ok", T.BooleanType()),
        *((c, longs) for c in NUMBERS[:4]), ("sha", T.StringType()), ("groups", bytes_), ("own", bytes_), ("n_pairs", longs),
        ("at", bytes_), ("times", bytes_), ("pairs", bytes_), ("holders", bytes_))])
    table = saved(units.mapInArrow(_blocks(path_a, path_b, to_arrow_schema(schema)), schema), "alignment-blocks")
    texts = table.filter("pairs is null")
    listed = table.filter("pairs is not null").select("block", "pairs", "holders").mapInArrow(_flat, "block long, pair long, holders long")
    held = listed.select("pair", "holders")
    parts = texts.filter("row is not null")
    if some:
        true = parts.groupBy("row").agg(F.min("ok").alias("ok")).filter("ok").select("row")
        own = parts.select("row", "own").join(true, "row", "left_semi").mapInArrow(_flat_rows, "row long, pair long").distinct()
        held = held.union(own.select("pair", F.lit(1).cast("long")))
    counts = saved(held.groupBy("pair").agg(F.sum("holders").alias("count")), "alignment-counts")
    token = F.shiftright("pair", 32)
    most = counts.groupBy(token.alias("a")).agg(F.max("count").alias("most"))
    known = counts.join(most, token == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = listed.select("block", "pair").join(known, "pair")
    kinds = T.StructType([*(schema[c] for c in ("doc_id", "row", "ok", *NUMBERS[:4], "sha")), *(T.StructField(c, longs) for c in NUMBERS[4:])])
    out = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_summed, kinds)
    final = ["doc_id", *NUMBERS, F.col("sha").alias("groups_sha256")]
    if not some:
        return out.select(*final)
    out = saved(out, "alignment-rows")
    sha = parts.select("row", "part", "groups").repartition("row").sortWithinPartitions("row", "part").mapInArrow(_digests, "row long, sha string")
    sums = out.filter("row is not null").groupBy("row").agg(F.min("ok").alias("ok"), *[F.sum(c).alias(c) for c in NUMBERS])
    whole = long.select("row", "doc_id").join(sums, "row").join(sha, "row")
    whole = whole.select("doc_id", *[F.when(F.col("ok"), F.col(c)).otherwise(0).alias(c) for c in NUMBERS],
                         F.when(F.col("ok"), F.col("sha")).otherwise("").alias("groups_sha256"))
    return out.filter("row is null").select(*final).union(whole)
