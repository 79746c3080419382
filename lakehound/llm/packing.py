"""Op 5: packing documents along a Hilbert curve.

A document's token ids are projected to DIMENSIONS numbers (sums of hashed
signs, by the tokens); their place on a Hilbert curve, with some bits of a hash
of doc_id below it, is its key. Ranges of keys, balanced on a sample, are sorted
each in its task, so neighbours on the curve stand next to each other, and the
run of all tokens is cut every LENGTH ids: only the last sequence is short. A
range numbers its own tokens; the ranges' totals, summed in order, give where
each begins, so no task sees more than its share.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lakehound.llm import words as W
from lakehound.llm.pieces import Cache
from lakehound.llm.shared import saved, worker_forgets, worker_keeps

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS, SCALE = 4, 12, 4.0
#: Bits below the curve's that deal equal documents out to several ranges.
TIE_BITS = 15
#: Documents whose keys balance the ranges (about), and ranges for each shuffle partition.
SAMPLE_DOCS, RANGES = 8192, 4
#: Different text pieces whose ids a worker remembers.
CACHE_PIECES = 500_000
#: Pieces encoded as one text, and such texts at once.
_JOINED, _ENCODED_AT_ONCE = 32, 256

#: Pieces start where no token of a byte-level BPE can reach across: at a blank before a byte that is surely no white
#: space, after an ASCII letter before an ASCII byte that is none, and before an ASCII letter after an ASCII byte that is
#: no letter, white space (what follows decides how a run of it is cut) or apostrophe.
_SURE = np.ones(256, dtype=bool)
_SURE[:33] = False
_SURE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_OTHER = np.zeros(256, dtype=bool)
_OTHER[:128] = ~_LETTER[:128]
_ENDS = _OTHER.copy()
_ENDS[:33] = False
_ENDS[39] = False


class Pieces:
    """Token ids of texts by their pieces: each different piece is encoded once and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        added = {i: len(x.content.encode()) for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        # a byte-level token has a letter for each byte
        self.sizes = np.array([added.get(i, len(self.tokenizer.id_to_token(i) or "")) for i in range(size)], dtype=np.int64)
        self.signs = _signs(size)
        self.cache = Cache(CACHE_PIECES, {"ids": np.uint32})

    def ids(self, text: W.Text) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and where each row's begin."""
        data, n = text.data, len(text.data)
        start = np.zeros(n + 1, dtype=bool)
        start[:-1][1:] = (data[1:] == 32) & np.append(_SURE[data[2:]], False)[:max(n - 1, 0)]
        start[1:-1] |= _LETTER[data[:-1]] & _OTHER[data[1:]] | _ENDS[data[:-1]] & _LETTER[data[1:]]
        raw = data.tobytes()
        for token in self.added:  # an added token's own string is one piece
            at = raw.find(token)
            while at >= 0:
                start[at + 1:at + len(token)] = False
                start[[at, at + len(token)]] = True
                at = raw.find(token, at + len(token))
        start[text.offsets] = True
        starts = np.flatnonzero(start[:n])
        ends = np.append(starts[1:], n)
        keys = W.spans_hash(data, starts, ends)
        different, where, back = np.unique(keys, return_index=True, return_inverse=True)
        first, last = starts[where], ends[where]
        at = self.cache.places(different, lambda new: ({"ids": self._encoded([raw[a:b] for a, b in zip(first[new].tolist(), last[new].tolist(), strict=True)])}, {}, []))
        flat, begin = self.cache.runs("ids", at[back])
        return flat, begin[np.searchsorted(starts, text.offsets)]

    def _encoded(self, pieces: list[bytes], joined: int = _JOINED) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids; pieces that begin with a blank are encoded several at a time."""
        own = [0]
        for k in range(1, len(pieces)):
            if k - own[-1] >= joined or pieces[k][0] != 32 or len(pieces[k]) < 2 or not _SURE[pieces[k][1]]:
                own.append(k)
        own.append(len(pieces))
        texts = [b"".join(pieces[i:j]).decode() for i, j in zip(own[:-1], own[1:], strict=True)]
        lists = []
        for k in range(0, len(texts), _ENCODED_AT_ONCE):
            lists += [e.ids for e in self.tokenizer.encode_batch_fast(texts[k:k + _ENCODED_AT_ONCE], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))
        ends = np.cumsum(self.sizes[flat])
        bounds = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        behind = np.searchsorted(ends, bounds, side="right")
        if joined > 1 and not np.array_equal(np.append(0, ends)[behind], bounds):
            return self._encoded(pieces, 1)
        return np.diff(behind, prepend=0), flat


def _signs(vocabulary: int) -> np.ndarray:
    h = W.mix(np.arange(1, vocabulary + 1, dtype=np.uint64))
    return np.stack([((h >> np.uint64(d)) & np.uint64(1)).astype(np.float32) * 2 - 1 for d in range(DIMENSIONS)])


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, d) with ``bits`` bits each.

    Skilling's transform: undo the excess work from the highest bit down, Gray-encode, interleave.
    """
    x = points.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << 1 | (x[i] >> b & 1)
    return out


def _curve_keys(ids: np.ndarray, first: np.ndarray, signs: np.ndarray) -> np.ndarray:
    counts = np.diff(first)
    points = np.zeros((len(counts), DIMENSIONS), dtype=np.int64)
    for d in range(DIMENSIONS):
        total = np.zeros(len(ids) + 1)
        np.cumsum(signs[d][ids], out=total[1:])
        mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(counts, 1)
        points[:, d] = np.clip((SCALE * mean + 1) / 2 * ((1 << BITS) - 1), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(points)


def _tokenized(path: str, bounds: np.ndarray):
    """doc_id, the range of the key, the key, tokens and ids of rows (doc_id, text, tie)."""
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_keeps(("packing", path), lambda: Pieces(path))
        for batch, text in W.slices(batches, "text"):
            ids, first = own.ids(text)
            keys = _curve_keys(ids, first, own.signs) << TIE_BITS | batch.column("tie").to_numpy(zero_copy_only=False)
            small = np.insert(ids, first[1:], END_ID).astype("<u2" if own.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
            ends = first + np.arange(len(first))
            lists = pa.Array.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer((ends * small.itemsize).astype(np.int64)), pa.py_buffer(small)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.searchsorted(bounds, keys, side="right").astype(np.int32)), pa.array(keys),
                 pa.array(np.diff(ends)), lists.cast(pa.binary())], names=["doc_id", "part", "key", "doc_tokens", "ids"])
    return tokenize


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``local``, the tokens of the same range before a row; rows come sorted by range."""
    worker_forgets()  # the tokenizer and its pieces: the range sort lies between
    last, begin = None, 0
    for batch in batches:
        part, tokens = batch.column("part").to_numpy(), batch.column("doc_tokens").to_numpy()
        local = np.cumsum(tokens) - tokens
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
        back = np.repeat(local[heads], np.diff(np.append(heads, len(part))))
        local = local - back
        if len(part) and part[0] == last:
            local[:heads[1] if len(heads) > 1 else len(part)] += begin
        if len(part):
            last, begin = part[-1], int(local[-1] + tokens[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "local"])


def _cut(width: int, length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_forgets()
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "ids", "doc_tokens", "at")]
            for doc_id, raw, tokens, at in zip(*columns, strict=True):
                ids = np.frombuffer(raw, kind).astype("<u4")
                start = 0
                while start < tokens:
                    offset = (at + start) % length
                    n = min(length - offset, tokens - start)
                    for k, x in enumerate((doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), tokens, (at + start) // length, offset)):
                        out[k].append(x)
                    start += n
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.column("doc_id").type), *[pa.array(x, pa.int64()) for x in out[1:]]], names=PIECE)
    return cut


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of all of ``docs`` (doc_id, text) in sequences of ``length`` ids.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, at the same place on
    every executor. Null texts are empty; every document ends with END_ID, so it has a piece. Equal
    texts have equal keys; ties go by bits of a hash of doc_id, then doc_id; repeated rows are packed each.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    table = pieces_table(docs, tokenizer)
    totals = table.groupBy("part").agg((F.max(F.col("local") + F.col("doc_tokens"))).alias("tokens"))
    # one row a range: a running sum over a list about as long as the number of tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("begin"))
    rows = table.join(F.broadcast(begins), "part").select("doc_id", "ids", "doc_tokens", (F.col("begin") + F.col("local")).alias("at"))
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    kinds = [table.schema["doc_id"].dataType, *[T.LongType()] * 6]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(PIECE, kinds, strict=True)])
    return rows.mapInArrow(_cut(width, length), schema)


def pieces_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary) and each document's place in its partition of the sorted run, as a written table."""
    spark = docs.sparkSession
    tie = F.pmod(F.xxhash64(F.lit("tie"), F.col("doc_id")), F.lit(1 << TIE_BITS))
    rows = docs.select("doc_id", "text", tie.alias("tie"))
    fields = [rows.schema["doc_id"], T.StructField("part", T.IntegerType()), T.StructField("key", T.LongType()),
              T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    # the sample decides only how even the ranges are; every row is placed by its own key
    share = SAMPLE_DOCS / max(1, docs.count())
    some = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) < int(share * (1 << 30)))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # longs as they are: a double would lose the bits that deal equal documents out
    sampled = some.mapInArrow(_tokenized(tokenizer, np.zeros(0, np.int64)), T.StructType(fields)).select("key").toArrow()["key"].to_numpy()
    places = np.arange(1, ranges) * len(sampled) // ranges
    bounds = np.unique(np.sort(sampled)[places]) if len(sampled) else np.zeros(0, np.int64)
    tokens = rows.mapInArrow(_tokenized(tokenizer, bounds), T.StructType(fields))
    sorted_ = tokens.repartition("part").sortWithinPartitions("part", "key", "doc_id").drop("key")
    placed = T.StructType([*sorted_.schema.fields, T.StructField("local", T.LongType())])
    return saved(sorted_.mapInArrow(_placed, placed), "packing")
