"""Words and shingles of Arrow text batches as numpy arrays.

Tasks hash whole column buffers at once: every word of a batch gets a 64-bit
value from one running polynomial sum over the UTF-8 bytes, so no Python
object is made per word. Rows are taken in slices of about ``SLICE_BYTES``
text (a longer single text is one slice), which bounds a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
SHINGLE_WORDS = 5

#: ASCII white space of every contract here: blank, \t \n \v \f \r.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: White space and ASCII punctuation, for operators that compare bare words.
IS_APART = IS_SPACE.copy()
IS_APART[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLOTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 step)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        full = np.full(max(n, SLICE_BYTES * 5 // 4), base, dtype=np.uint64)
        full[0] = 1
        have = _powers[name] = np.cumprod(full, dtype=np.uint64)
    return have[:n]


@dataclass
class Text:
    """The texts of some rows as one byte array; row i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words in reading order: byte bounds, row, and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray


def flat(column: pa.Array) -> Text:
    """A string or binary column without nulls' bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return Text(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * np.dtype(kind).itemsize)
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Text(raw[at[0]:at[-1]], at - at[0])


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Text]]:
    """Cut every batch into runs of rows with about ``most`` bytes of text."""
    for batch in batches:
        whole = flat(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(whole.offsets, whole.offsets[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            at = whole.offsets[start:stop + 1]
            yield batch.slice(start, stop - start), Text(whole.data[at[0]:at[-1]], at - at[0])
            start = stop


def split(text: Text, separators: np.ndarray = IS_SPACE) -> Words:
    """Runs of bytes that are no separators; a row's end also ends a word."""
    n = len(text.data)
    inside = ~separators[text.data]
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    edge = text.offsets[(text.offsets < n)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before[:n])
    after = np.empty(n + 1, dtype=bool)
    after[:n] = inside
    after[n] = False
    after[text.offsets[text.offsets > 0]] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(starts, text.offsets)
    row = np.repeat(np.arange(text.rows), np.diff(first))
    return Words(starts, ends, row, first)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value of each byte span data[starts:ends] (equal bytes, equal value)."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("inverse", _INVERSE, n + 1)[starts])


def word_hashes(text: Text, lower: bool = True) -> tuple[Words, np.ndarray]:
    words = split(text)
    return words, spans_hash(LOWER[text.data] if lower else text.data, words.starts, words.ends)


def windows_hash(values: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """One value for each run of ``width`` neighbours in ``values``, in order."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        slot = _SLOTS[k % len(_SLOTS)] + np.uint64(2 * (k // len(_SLOTS)))
        total += values[k:k + n] * slot
    return mix(total)


def shingle_lists(text: Text, lower: bool = True, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All shingles, with repeats, of a slice in reading order.

    Returns (values, first, words per row); row i has values[first[i]:first[i + 1]].
    A row of 1 to width - 1 words has one shingle, its whole sequence; a row without words none.
    """
    words, hashes = word_hashes(text, lower)
    counts = np.diff(words.first)
    all_windows = windows_hash(hashes, width)
    have = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(have, out=first[1:])
    values = np.empty(first[-1], dtype=np.uint64)
    long_rows = counts >= width
    begin = np.repeat(words.first[:-1], have)
    at = np.arange(first[-1]) - np.repeat(first[:-1], have) + begin
    full = np.repeat(long_rows, have)
    values[full] = all_windows[at[full]]
    for i in np.flatnonzero(~long_rows & (counts > 0)):
        own = hashes[words.first[i]:words.first[i + 1]]
        values[first[i]] = mix(windows_hash(own, len(own)) + np.uint64(len(own)))[0]
    return values, first, counts


def shingle_sets(text: Text, lower: bool = True, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each row."""
    values, first, _ = shingle_lists(text, lower, width)
    return [np.unique(values[first[i]:first[i + 1]]) for i in range(len(first) - 1)]
