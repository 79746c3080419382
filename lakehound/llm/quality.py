"""Op 4: quality rules with cross-document line frequency.

Lines are normalised (words in lower case, single blanks) and hashed; for each
host the distinct documents (doc_ids) that hold a line are counted. Lines
above the limit are boilerplate: they are taken out, and a document that has
too few words left is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehound.llm import words as W
from lakehound.llm.shared import saved

MIN_WORDS = 10
REPEAT_PERCENT = 20
#: A line in more than so many different documents of a host is boilerplate.
LINE_DOCS = 20
#: A document keeps at least this percentage of its words without boilerplate, and MIN_WORDS words.
LEFT_PERCENT = 40

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[10] = True

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "struct<" + ", ".join(f"{c}: bigint" for c in BASE) + ", lines: array<struct<line: bigint, words: bigint>>>"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _sequence_hash(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit value of each run values[first[i]:first[i + 1]], by the words' order."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * W._power("base", W._BASE, len(values)), out=total[1:])
    back = W._power("inverse", W._INVERSE, len(values) + 1)
    return W.mix((total[first[1:]] - total[first[:-1]]) * back[first[:-1]])


def measures(text: W.Text) -> tuple[dict[str, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """The base counts of each row, and each row's distinct normalised lines with their words."""
    words, raw = W.word_hashes(text, lower=False)
    counts = np.diff(words.first)
    inside = ~W.IS_SPACE[text.data] & ((text.data & 0xC0) != 0x80)
    out = {"n_words": counts, "word_chars": _sums(inside, text.offsets), "n_symbols": _sums(_SYMBOL[text.data], text.offsets)}
    lowered = W.spans_hash(W.LOWER[text.data], words.starts, words.ends)
    lines = W.split(text, _BREAK)
    line_hash = W.spans_hash(text.data, lines.starts, lines.ends)
    windows = W.windows_hash(raw)
    # words of each line: a word never crosses a line, so lines cut the words' sequence
    cut = np.append(np.searchsorted(words.starts, lines.starts), len(words.starts))
    line_words = np.diff(cut)
    normal = _sequence_hash(lowered, cut) if len(lowered) else np.zeros(len(line_words), np.uint64)
    dup, repeat, own_lines = np.zeros(text.rows, np.int64), np.zeros(text.rows, np.int64), []
    for i in range(text.rows):
        a, b = lines.first[i], lines.first[i + 1]
        with_word = np.flatnonzero(line_words[a:b] > 0) + a
        dup[i] = len(with_word) - len(np.unique(line_hash[with_word]))
        keys, where, times = np.unique(normal[with_word], return_index=True, return_counts=True)
        own_lines.append((keys, line_words[with_word][where] * times))
        n = counts[i]
        if n > W.SHINGLE_WORDS:
            own = windows[words.first[i]:words.first[i] + n - W.SHINGLE_WORDS + 1]
            order = np.argsort(own, kind="stable")
            same = own[order][1:] == own[order][:-1]
            if same.any():
                again = np.zeros(len(own), dtype=bool)
                again[order[1:][same]] = True
                again[order[:-1][same]] = True
                covered = np.zeros(n, dtype=bool)
                for k in range(W.SHINGLE_WORDS):
                    covered[k:k + len(own)] |= again
                repeat[i] = covered.sum()
    return out | {"n_dup_lines": dup, "n_repeat_words": repeat}, own_lines


def _measure_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        parts = []
        for _, text in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            base, lines = measures(text)
            offsets = np.cumsum([0] + [len(k) for k, _ in lines])
            keys = np.concatenate([k for k, _ in lines]).view(np.int64)
            weights = np.concatenate([w for _, w in lines])
            entry = pa.StructArray.from_arrays([pa.array(keys), pa.array(weights, pa.int64())], names=["line", "words"])
            parts.append(pa.StructArray.from_arrays(
                [pa.array(base[c], pa.int64()) for c in BASE] + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entry)],
                names=[*BASE, "lines"]))
        yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.struct([(c, pa.int64()) for c in BASE] + [
            ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))]))


def judge_quality(docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """Base measures and verdict of every row of ``docs`` (doc_id, text and the host column).

    Null and empty texts have no words and fail the base rules. A null host counts as one host.
    A line's documents are its distinct doc_ids, copies of a text under other ids included; rows that
    repeat a doc_id count once, as do all rows without one. Every row is judged.
    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    and n_boilerplate_words, the words in lines above the limit.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col(host).alias("host"),
                       F.arrow_udf(_measure_batches, SCHEMA)("text").alias("m"))
    table = saved(rows.select("rid", "doc_id", "host", "m.*"), "quality")
    lines = table.select("rid", "doc_id", "host", F.explode("lines").alias("x")).select("rid", "doc_id", "host", "x.line", "x.words")
    common = (lines.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > line_docs).select(F.col("host").alias("h"), F.col("line").alias("l")))
    removed = (lines.join(common, (F.col("line") == F.col("l")) & F.col("host").eqNullSafe(F.col("h")), "left_semi")
               .groupBy("rid").agg(F.sum("words").alias("n_boilerplate_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    gone = F.coalesce("n_boilerplate_words", F.lit(0))
    left = F.col("n_words") - gone
    enough = (left >= MIN_WORDS) & (100 * left >= left_percent * F.col("n_words"))
    return table.drop("lines").join(removed, "rid", "left").select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & enough).alias("kept"), gone.alias("n_boilerplate_words"))
