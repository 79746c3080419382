"""Op 8: language identification by cross-parsing entropy.

Each language has a suffix automaton of a bounded sample of its labelled text.
A text is parsed greedily into the longest phrases that occur in a language's
sample; the language that needs the fewest phrases, normalised by the
logarithm of its sample's length, wins. Whole texts are parsed, in blocks that
all tasks step through side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehound.llm import words as W
from lakehound.llm.shared import saved, worker_keeps

#: The sample of a language: at most so many different texts, and bytes in all.
SAMPLE_DOCS, SAMPLE_BYTES = 64, 40960
#: Texts of a language (about) that are ordered to find the SAMPLE_DOCS first; fewer than those among them has no measurable chance.
CUT_DOCS = 1024
#: Bytes of a piece; a text longer than its share gives pieces chosen by hash over its whole length.
PIECE_BYTES = 128
#: Symbols of a block; a phrase ends with its block.
BLOCK = 512
UNDETERMINED = "und"
_AT_ONCE = 2048
_PHRASE = np.int32(1 << 30)
_STATE = np.int32((1 << 30) - 1)


def _symbols(samples: dict[str, bytes]) -> tuple[np.ndarray, int]:
    """Byte to symbol: 0 pads, 1 is any ASCII byte that is no letter, then letters and seen bytes, last all others."""
    table = np.ones(256, dtype=np.uint8)
    seen = sorted({b for text in samples.values() for b in text if b >= 128})
    for i, b in enumerate(seen):
        table[b] = 28 + i
    size = 28 + len(seen) + 1
    table[[b for b in range(128, 256) if b not in set(seen)]] = size - 1
    for i in range(26):
        table[65 + i] = table[97 + i] = 2 + i
    return table, size


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions [state, symbol], -1 where a symbol leads out of the text's substrings.

    The table is filled in place: a worker holds no other copy of the automaton.
    """
    moves = np.full((2 * len(symbols) + 2, size), -1, dtype=np.int32)
    link, length, last, states = [-1], [0], 0, 1
    for c in symbols:
        new, states = states, states + 1
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and moves[at, c] < 0:
            moves[at, c] = new
            at = link[at]
        if at >= 0:
            to = int(moves[at, c])
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy, states = states, states + 1
                moves[copy] = moves[to]
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = copy
                while at >= 0 and moves[at, c] == to:
                    moves[at, c] = copy
                    at = link[at]
        last = new
    return moves[:states]


@dataclass
class Parser:
    """All languages' automata in one table; a move that ends a phrase carries the _PHRASE bit."""

    languages: list[str]
    weights: np.ndarray
    symbols: np.ndarray
    roots: np.ndarray
    moves: np.ndarray
    size: int

    @classmethod
    def of(cls, samples: dict[str, bytes]) -> Parser:
        symbols, size = _symbols(samples)
        own = {lang: _collapsed(symbols[np.frombuffer(samples[lang], np.uint8)]) for lang in sorted(samples)}
        # room for all, of which only what is written takes memory: one automaton at a time stands beside it
        moves = np.empty((sum(2 * len(x) + 3 for x in own.values()), size), dtype=np.int32)
        roots, base = [], 0
        for seq in own.values():
            table = suffix_automaton(seq.tolist(), size)
            # a symbol that the sample lacks is a phrase of its own: the state behind the last one, which any move leaves
            alone = len(table)
            start = np.where(table[0] >= 0, table[0], alone).astype(np.int32) + np.int32(base)
            into = moves[base:base + alone + 1]
            np.add(table, np.int32(base), out=into[:alone])
            np.copyto(into[:alone], start | _PHRASE, where=table < 0)
            into[0], into[alone] = start, start | _PHRASE
            into[:, 0] = base
            roots.append(base)
            base += alone + 1
            del table
        weights = np.array([np.log2(len(samples[x]) + 2) for x in sorted(samples)])
        return cls(sorted(samples), weights, symbols, np.array(roots, np.int32), moves[:base].ravel(), size)

    def phrases(self, text: W.Text) -> tuple[np.ndarray, np.ndarray]:
        """(rows, languages) phrases, and the symbols of each row."""
        sym = self.symbols[text.data]
        gap = sym == 1
        again = np.empty(len(sym), dtype=bool)
        again[1:] = gap[:-1]
        again[:1] = True
        again[text.offsets[:-1][text.offsets[:-1] < len(sym)]] = True
        keep = ~(gap & again)
        kept = np.zeros(len(sym) + 1, dtype=np.int64)
        np.cumsum(keep, out=kept[1:])
        ends = kept[text.offsets]
        lengths = np.diff(ends)
        blocks = -(-lengths // BLOCK)
        first = np.zeros(text.rows + 1, dtype=np.int64)
        np.cumsum(blocks, out=first[1:])
        flat = np.zeros(first[-1] * BLOCK, dtype=np.uint8)
        flat[np.arange(ends[-1]) + np.repeat(first[:-1] * BLOCK - ends[:-1], lengths)] = sym[keep]
        grid = flat.reshape(-1, BLOCK)
        counts = np.zeros((len(self.languages), len(grid)), dtype=np.int64)
        for a in range(0, len(grid), _AT_ONCE):
            part = np.ascontiguousarray(grid[a:a + _AT_ONCE].T).astype(np.int32)
            state = np.repeat(self.roots[:, None], part.shape[1], axis=1)
            ended = np.zeros(state.shape, dtype=np.int32)
            for column in part:
                if not column.any():
                    break
                move = np.take(self.moves, state * self.size + column)
                ended += move >= _PHRASE
                state = move & _STATE
            counts[:, a:a + _AT_ONCE] = ended + 1
        total = np.zeros((len(self.languages), first[-1] + 1), dtype=np.int64)
        np.cumsum(counts, axis=1, out=total[:, 1:])
        return (total[:, first[1:]] - total[:, first[:-1]]).T, lengths

    def decide(self, text: W.Text) -> tuple[np.ndarray, np.ndarray]:
        """The winner's index (the first of equals) and its share of the inverse costs."""
        phrases, _ = self.phrases(text)
        cost = np.maximum(phrases, 1) * self.weights
        inverse = 1 / cost
        return cost.argmin(axis=1), inverse.max(axis=1) / inverse.sum(axis=1)


def _collapsed(symbols: np.ndarray) -> np.ndarray:
    gap = symbols == 1
    return symbols[~(gap & np.append(True, gap[:-1]))] if len(symbols) else symbols


def learning_rows(doc_id: Column) -> Column:
    """True for the rows that labels may be learnt from; a null doc_id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def _pieces(text: bytes, most: int) -> bytes:
    """The whole text if it fits in ``most`` bytes, else pieces of it in reading order, chosen by hash; none cuts a character."""
    if len(text) <= most:
        return text
    cuts = [a + next((k for k in range(4) if a + k >= len(text) or text[a + k] & 0xC0 != 0x80), 0) for a in range(0, len(text), PIECE_BYTES)]
    parts = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
    first = W.mix(np.array([zlib.crc32(text)], np.uint64))
    rank = W.mix(np.arange(len(parts), dtype=np.uint64) + first)
    chosen, left = [], most
    for i in np.argsort(rank, kind="stable").tolist():
        if len(parts[i]) + 1 > left:
            break
        chosen.append(i)
        left -= len(parts[i]) + 1
    return b" ".join(parts[i] for i in sorted(chosen))


def _shares(sizes: list[int], total: int) -> list[int]:
    """Bytes for each of some texts: short ones whole, what they leave goes to the longer ones in equal parts."""
    out = [0] * len(sizes)
    for done, i in enumerate(sorted(range(len(sizes)), key=lambda i: sizes[i])):
        out[i] = min(sizes[i], total // (len(sizes) - done))
        total -= out[i]
    return out


def _cut(most: Column, text: Column) -> Column:
    @F.arrow_udf("binary")
    def cut(most: pa.Array, text: pa.Array) -> pa.Array:
        return pa.array([_pieces(t.encode(), n) for n, t in zip(most.to_pylist(), text.to_pylist(), strict=True)], pa.binary())

    return cut(most, text)


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Bounded samples by language, from the different texts of learning rows with the smallest hash.

    Copies of a text count once. Hashes are chosen first, per language, without moving a text: a cut of the
    hash by the language's number of texts leaves a few hundred of them to be ordered. Then one row of
    each chosen text is read and cut where it lies; the driver gets SAMPLE_BYTES a language at most.
    Every chosen text gives its share, as pieces from its whole length.
    """
    usable = docs.filter(learning_rows(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").alias("lang"), "doc_id", "text", F.xxhash64("text").alias("same"))
    place = F.xxhash64(F.lit("sample"), "same")
    different = saved(usable.groupBy("lang", "same").agg(F.min("doc_id").alias("doc_id"), F.max(F.octet_length("text")).alias("size")).withColumn("place", place), "langid-texts")
    sizes = different.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # a hash is even over 64 bits: of n texts about CUT_DOCS lie below this
    low = F.lit(-float(1 << 63)) + F.least(F.lit(1.0), F.lit(float(CUT_DOCS)) / F.col("n")) * float(1 << 64)
    # one row a language, fewer than the samples that the driver holds; so no text's row moves before the cut
    few = different.join(F.broadcast(sizes), "lang").filter((F.col("n") <= CUT_DOCS) | (F.col("place").cast("double") < low))
    order = Window.partitionBy("lang").orderBy("place", "same")
    chosen = few.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE_DOCS).select("lang", "same", "doc_id", "size").collect()
    if not chosen:
        return {}
    shares = []
    for lang in {r.lang for r in chosen}:
        own = [r for r in chosen if r.lang == lang]
        shares += [(lang, r.same, r.doc_id, n) for r, n in zip(own, _shares([r.size for r in own], SAMPLE_BYTES - len(own)), strict=True)]
    spark = docs.sparkSession
    kind = usable.schema["doc_id"].dataType.simpleString()
    wanted = spark.createDataFrame(shares, f"lang {usable.schema['lang'].dataType.simpleString()}, same long, doc_id {kind}, most int")
    rows = usable.join(F.broadcast(wanted), ["lang", "same", "doc_id"])  # SAMPLE_DOCS rows a language
    rows = rows.select("lang", "same", _cut(F.col("most"), F.col("text")).alias("part")).groupBy("lang", "same").agg(F.min("part").alias("part"))
    texts: dict[str, list[bytes]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r.lang, r.same)):
        texts.setdefault(r.lang, []).append(bytes(r.part))
    return {lang: b" ".join(own) for lang, own in texts.items()}


def predicted(spark, samples: dict[str, bytes], text: Column) -> Column:
    """struct<lang_pred, score> of a text column; und and 0 for null texts and texts without a letter."""
    kept = spark.sparkContext.broadcast(samples)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = worker_keeps(("langid", hash(tuple(sorted(kept.value.items())))), lambda: Parser.of(kept.value)) if kept.value else None
        for column in texts:
            names: list[str] = []
            scores: list[float] = []
            for _, part in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
                lettered = _has_letter(part)
                if parser is None:
                    names += [UNDETERMINED] * part.rows
                    scores += [0.0] * part.rows
                    continue
                best, share = parser.decide(part)
                names += [parser.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
                scores += np.where(lettered, share, 0.0).tolist()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return predict(text)


_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _has_letter(text: W.Text) -> np.ndarray:
    total = np.zeros(len(text.data) + 1, dtype=np.int64)
    np.cumsum(_ASCII_LETTER[text.data], out=total[1:])
    out = np.diff(total[text.offsets]) > 0
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in text.data[text.offsets[i]:text.offsets[i + 1]].tobytes().decode())
    return out


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the learning rows of ``docs`` (doc_id, text, lang) and predict every row.

    Repeated rows are predicted each; ties go to the language first in order. With no usable label
    every prediction is und. Returns doc_id, held_out, lang_pred, score.
    """
    result = predicted(docs.sparkSession, learn(docs), F.col("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), result.alias("r")).select("doc_id", "held_out", "r.*")
