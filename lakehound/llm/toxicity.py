"""Op 2: toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models, one of toxic and one of ordinary text, share
their lowest order: continuation counts (how many different words precede a
word) gathered over the whole corpus, all of them exact. A class that lacks a
bigram backs off to its own continuation counts, and from there to the shared
ones, so rare expressions cancel out; bigrams are counted by the words before
them too, so many copies of one text raise nothing. Discounts come from the
counts of counts of each class and order. A text's evidence is its log-likelihood
ratio, normalised by length: per word, per root of the words (the noise of
that many words), in the strongest window of WINDOW words, which keeps an
insult in a long text visible, and of what single words show beyond STRONG. A logistic regression on other labelled rows
turns them into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.llm import words as W
from lakehound.llm.shared import saved

#: Labelled rows of each class that the class counts, and of both that the calibration, are fitted on (about).
CLASS_ROWS, CALIBRATION_ROWS = 12_000, 20_000
#: Words and bigrams that the model keeps, by their counts; all others back off.
MODEL_WORDS, MODEL_BIGRAMS = 1 << 18, 1 << 21
#: Where counts of counts tell no discount, or one outside.
LEAST_DISCOUNT, MOST_DISCOUNT = 0.1, 0.95
#: Bigrams that a task holds before it sends the distinct ones; buckets for each shuffle partition that they are dealt to.
HELD_PAIRS, BUCKETS = 1 << 20, 4
#: Documents (about) whose words tell the frequent ones, and a frequent word's share of them.
SAMPLE_DOCS, HOT_SHARE = 8192, 4096
WINDOW, STRONG = 16, (1.5, 2.5)
_BATCH_BYTES = 1 << 20
SENT = T.StructType([T.StructField("bucket", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("words", "n", "before")]])
WAYS = T.StructType([T.StructField("w", T.IntegerType()), T.StructField("ways", T.LongType()), T.StructField("kinds", T.LongType())])
COUNTS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("before", "u", "w", "toxic")])


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text mod 5; a null id is fold 0, which nothing is learnt from."""
    return F.coalesce((F.crc32(doc_id.cast("string")) % 5).cast("int"), F.lit(0))


def _tokens(text: W.Text) -> tuple[np.ndarray, np.ndarray]:
    """32-bit word values and the first word of each row."""
    words = W.split(text, W.IS_APART)
    values = W.spans_hash(W.LOWER[text.data], words.starts, words.ends)
    return (values >> np.uint64(32)).astype(np.uint32), words.first


def _prior(value: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``of`` of the word before every word; 0 at the start of a row."""
    out = np.roll(of, 1)
    out[first[:-1][first[:-1] < len(value)]] = 0
    return out


def _sent(pairs: np.ndarray, hot: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket: its words, how many words precede each, and those. ``pairs`` are sorted (word, word before it)."""
    word = (pairs >> np.uint64(32)).astype(np.uint32)
    # a frequent word's pairs are dealt by both words, all others by the word
    bucket = W.mix(np.where(_among(word, hot), pairs, word.astype(np.uint64))) % np.uint64(buckets)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    bucket, word, before = bucket[order].astype(np.int32), word[order], pairs[order].astype(np.uint32)
    begin = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (bucket[1:] != bucket[:-1])))
    n = np.diff(np.append(begin, len(word))).astype(np.uint32)
    own = np.flatnonzero(np.append(True, bucket[begin][1:] != bucket[begin][:-1]))
    ends = np.append(own, len(begin))
    cut = np.append(begin, len(word))[ends]
    parts = [[x[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)] for x, at in ((word[begin], ends), (n, ends), (before, cut))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[begin][own], pa.int32()), *[pa.array(x, pa.binary()) for x in parts]], names=SENT.names)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``table``."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _preceded(hot: np.ndarray, buckets: int):
    """The distinct words before every word, by buckets; a row's first word comes after 0."""
    def preceded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, text in W.slices(batches, "text", _BATCH_BYTES):
            value, first = _tokens(text)
            held.append(np.unique(value.astype(np.uint64) << np.uint64(32) | _prior(value, first, value)))
            size += len(held[-1])
            if size > HELD_PAIRS:
                yield _sent(np.unique(np.concatenate(held)), hot, buckets)
                held, size = [], 0
        if size:
            yield _sent(np.unique(np.concatenate(held)), hot, buckets)
    return preceded


def _distinct(hot: np.ndarray, only: np.ndarray | None):
    """(w, ways, kinds) of every bucket: how many different words of it precede w, for the words ``only`` and frequent ones;
    with null w the bucket's different pairs and its words that are not frequent."""
    def counted(run: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique((np.unique(np.concatenate(run)) >> np.uint64(32)).astype(np.uint32), return_counts=True)
        spread = _among(word, hot)
        keep = spread | _among(word, only) if only is not None else np.ones(len(word), dtype=bool)
        words = pa.concat_arrays([pa.array(word[keep].view(np.int32)), pa.array([None], pa.int32())])
        kinds = np.append(np.zeros(int(keep.sum()), np.int64), int((~spread).sum()))
        return pa.RecordBatch.from_arrays([words, pa.array(np.append(n[keep], n.sum())), pa.array(kinds)], names=WAYS.names)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last = [], None
        for batch in batches:
            for bucket, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word, n, before = (np.frombuffer(x, np.uint32) for x in parts)
                if bucket != last and run:
                    yield counted(run)
                    run = []
                last = bucket
                run.append(np.repeat(word, n).astype(np.uint64) << np.uint64(32) | before)
        if run:
            yield counted(run)
    return distinct


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, text in W.slices(batches, "text", _BATCH_BYTES):
        word, n = np.unique(_tokens(text)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int32)), pa.array(n)], names=["w", "n"])


def _frequent(docs: DataFrame) -> np.ndarray:
    """Words that are more than one in HOT_SHARE of those of a sample (so at most HOT_SHARE); they only deal the work out."""
    share = SAMPLE_DOCS / max(1, docs.count())
    some = docs.filter(F.pmod(F.xxhash64(F.lit("hot"), F.col("doc_id")), F.lit(1 << 30)) < int(min(share, 1) * (1 << 30)))
    counts = some.select("text").mapInArrow(_word_counts, "w int, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return np.sort(counts.filter(F.col("n") * HOT_SHARE > total).select("w").toArrow()["w"].to_numpy().view(np.uint32))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct rows (before, u, w, toxic): two words of a row of that label and the word before them; 0 before a row's first."""
    for batch, text in W.slices(batches, "text", _BATCH_BYTES):
        value, first = _tokens(text)
        u = _prior(value, first, value)
        before = _prior(value, first, u)
        toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int32), np.diff(first))
        order = np.lexsort((before, value, u, toxic))
        rows = [x[order] for x in (before, u, value, toxic)]
        new = np.ones(len(value), dtype=bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in rows], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(x[new].view(np.int32)) for x in rows], names=COUNTS.names)


@dataclass
class Model:
    """Sorted words and bigrams with each class's parts of the interpolated probabilities."""

    words: np.ndarray       # uint32
    single: np.ndarray      # (2, words): unigram probabilities
    back: np.ndarray        # (2, words): weight of the unigram after this word
    unseen: np.ndarray      # (2,): weight of the shared order for a word not kept
    pairs: np.ndarray       # uint64
    direct: np.ndarray      # (2, pairs): discounted bigram probabilities

    def ratios(self, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log P_toxic / P_ordinary of every word, given the word before it in its row."""
        if not len(self.words) or not len(value):
            return np.zeros(len(value))
        at = np.minimum(np.searchsorted(self.words, value), len(self.words) - 1)
        known = self.words[at] == value
        p = np.where(known, self.single[:, at], self.unseen[:, None])
        weight = np.where(known, self.back[:, at], 1.0)
        after = np.ones_like(p)
        after[:, 1:] = weight[:, :-1]
        begin = first[:-1][first[:-1] < len(value)]
        after[:, begin] = 1.0
        p = p * after
        if len(self.pairs):
            prior = np.roll(value, 1)
            pair = prior.astype(np.uint64) << np.uint64(32) | value
            spot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            found = self.pairs[spot] == pair
            found[begin] = False
            hit = np.flatnonzero(found)
            p[:, hit] += self.direct[:, spot[hit]]
        return np.log(p[1]) - np.log(p[0])

    def evidence(self, text: W.Text) -> tuple[np.ndarray, ...]:
        """Per row: the strongest window's ratio by WINDOW, the whole text's by its words and by their root, and the strong part by both."""
        value, first = _tokens(text)
        ratios = self.ratios(value, first)
        total = np.zeros(len(value) + 1)
        np.cumsum(ratios, out=total[1:])
        counts = np.diff(first)
        whole = total[first[1:]] - total[first[:-1]]
        over = np.zeros((len(STRONG), len(value) + 1))
        np.cumsum([np.maximum(ratios - s, 0) for s in STRONG], axis=1, out=over[:, 1:])
        strong = over[:, first[1:]] - over[:, first[:-1]]
        window = np.zeros(text.rows)
        for i in np.flatnonzero(counts):
            own = total[first[i]:first[i + 1] + 1]
            window[i] = (own[WINDOW:] - own[:-WINDOW]).max() if len(own) > WINDOW else own[-1] - own[0]
        n = np.maximum(counts, 1)
        return window / WINDOW, whole / n, whole / np.sqrt(n), *(strong / n), *(strong / np.sqrt(n))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, fold of learning rows; an id with both labels counts as toxic."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return known.withColumn("fold", fold(F.col("doc_id"))).filter("fold <> 0")


def _share(rows: DataFrame, want: int, by: str | None = None) -> DataFrame:
    """About ``want`` rows, or as many of each value of ``by``, by the smallest hash of doc_id."""
    sizes = {r[0]: r.n for r in rows.groupBy(F.col(by) if by else F.lit(0).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    limit = F.lit(0.0)
    for value, n in sizes.items():
        limit = F.when((F.col(by) == value) if by else F.lit(True), want / n).otherwise(limit)
    return rows.filter(part < limit)


def _kept(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """The rows with the largest counts c0 + c1, about ``most``; of the last count that fits in part those with the smallest hash of ``key``."""
    count = F.col("c0") + F.col("c1")
    sizes = sorted(((r.c, r.n) for r in rows.groupBy(count.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total = 0
    for c, n in sizes:
        if total + n > most:
            part = F.pmod(F.xxhash64(F.lit("kept"), *key), F.lit(1 << 30)) / float(1 << 30)
            return rows.filter((count > c) | ((count == c) & (part < (most - total) / n)))
        total += n
    return rows


def _discounts(rows: DataFrame) -> np.ndarray:
    """n1 / (n1 + 2 n2) of the counts c0 and c1: how many are 1, and 2."""
    r = rows.agg(*[F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in ("c0", "c1") for k in (1, 2)]).first()
    one, two = np.array([r.c0_1, r.c1_1], float), np.array([r.c0_2, r.c1_2], float)
    return np.clip(one / np.maximum(one + 2 * two, 1), LEAST_DISCOUNT, MOST_DISCOUNT)


def _ways(docs: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """w, ways: the number of different words before every word (of ``only`` and frequent ones); with null w that of
    different bigrams, and in ``kinds`` that of words.

    Bigrams are made distinct by buckets of words; a frequent word's are spread over all buckets by the
    word before it, and its counts added up.
    """
    spark = docs.sparkSession
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = _frequent(docs)
    sent = docs.select("text").mapInArrow(_preceded(hot, buckets), SENT)
    known = spark.sparkContext.broadcast(only)
    parts = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: _distinct(hot, known.value)(batches), WAYS)
    ways = saved(parts.groupBy("w").agg(F.sum("ways").alias("ways"), F.sum("kinds").alias("kinds")), "continuations")
    known.destroy()
    spread = F.col("w").isin(hot.view(np.int32).tolist())
    return ways.withColumn("kinds", F.when(F.col("w").isNull(), F.col("kinds") + ways.agg(F.count_if(spread)).scalar()))


def continuations(docs: DataFrame) -> DataFrame:
    """w, ways: the exact number of different words before every word of ``docs`` (doc_id, text); the start of a row counts as one."""
    return _ways(docs).filter("w is not null").select("w", "ways")


def train(docs: DataFrame, sample: DataFrame) -> Model:
    """Counts of all of ``docs`` (doc_id, text) with the class counts of ``sample`` (doc_id, toxic; bounded).

    The driver gets the model's rows in order, 16 bytes a bigram, and nothing else that grows.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id", "toxic")), "doc_id").select("text", "toxic")
    # c0, c1: in each class, the distinct words before a bigram, then those before a word
    pairs = saved(rows.mapInArrow(_counted, COUNTS).distinct().groupBy("u", "w").agg(
        *[F.count_if(F.col("toxic") == k).alias(f"c{k}") for k in (0, 1)]), "kneser-ney")
    words = saved(pairs.groupBy("w").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in ("c0", "c1")]), "kneser-ney-words")
    all_ = words.agg(*[f(c).alias(n + c) for c in ("c0", "c1") for f, n in ((F.sum, "t"), (lambda c: F.count_if(F.col(c) > 0), "k"))]).first()
    if not all_.tc0 or not all_.tc1:
        return Model(np.zeros(0, np.uint32), np.zeros((2, 0)), np.zeros((2, 0)), np.ones(2), np.zeros(0, np.uint64), np.zeros((2, 0)))
    total, kinds, discount = np.array([all_.tc0, all_.tc1], float), np.array([all_.kc0, all_.kc1], float), _discounts(words)
    unsigned = F.col("w").bitwiseXOR(F.lit(-1 << 31).cast("int"))
    kept = saved(_kept(words, MODEL_WORDS, "w"), "kneser-ney-kept")
    vocabulary = kept.select("w").orderBy(unsigned).toArrow()["w"].to_numpy().view(np.uint32)
    ways = _ways(docs, vocabulary)
    different, kinds_all = ways.filter("w is null").select("ways", "kinds").first()
    # a row's first word follows no word
    after = pairs.filter("u <> 0")
    after_discount = _discounts(after)
    sums = after.groupBy("u").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"))
    parts = [F.coalesce(F.greatest(F.col(f"c{k}") - float(after_discount[k]), F.lit(0.0)) / F.nullif(F.col(f"n{k}"), F.lit(0)), F.lit(0.0)) for k in (0, 1)]
    two = _kept(after, MODEL_BIGRAMS, "u", "w").join(kept.select(F.col("w").alias("u")), "u").join(sums, "u")
    two = saved(two.select("u", "w", *[x.cast("float").alias(f"d{k}") for k, x in enumerate(parts)]), "kneser-ney-bigrams")
    # what discounts and bigrams that are not kept leave goes to the order below
    left = two.groupBy(F.col("u").alias("w")).agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in ("d0", "d1")])
    own = kept.join(ways.select("w", "ways"), "w").join(left, "w", "left").orderBy(unsigned).select(
        "c0", "c1", "ways", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("d0", "d1")]).toArrow()
    seen, back = (np.stack([own[c].to_numpy() for c in names]) for names in (("c0", "c1"), ("d0", "d1")))
    shared = (own["ways"].to_numpy() + 1) / (different + kinds_all)
    low = discount * kinds / total
    single = np.maximum(seen - discount[:, None], 0) / total[:, None] + low[:, None] * shared
    pair = F.shiftleft(F.col("u").cast("long"), 32).bitwiseOR(F.col("w").cast("long").bitwiseAND(F.lit((1 << 32) - 1)))
    two = two.select(pair.alias("pair"), "d0", "d1").orderBy(F.col("pair").bitwiseXOR(F.lit(-1 << 63))).toArrow()
    return Model(vocabulary, single.astype(np.float32), np.maximum(1 - back, 1e-6).astype(np.float32), low / (different + kinds_all),
                 two["pair"].to_numpy().view(np.uint64), np.stack([two[c].to_numpy() for c in ("d0", "d1")]))


def evidence(kept: Broadcast) -> Column:
    """The evidence of the text column under a broadcast model."""
    @F.arrow_udf("struct<window: double, whole: double, root: double, strong: double, strongest: double, strong_root: double, strongest_root: double>")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = [kept.value.evidence(t) for _, t in W.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text")]
            both = [np.concatenate(x) if parts else np.zeros(0) for x in (zip(*parts, strict=True) if parts else [[]] * len(LIMITS))]
            yield pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in both], names=list(LIMITS))

    return measured("text")


#: Evidence beyond these values says no more.
LIMITS = {"window": 4.0, "whole": 1.0, "root": 6.0, "strong": 0.5, "strongest": 0.5, "strong_root": 3.0, "strongest_root": 3.0}


def _inputs(evidence: str) -> list[Column]:
    return [F.greatest(F.lit(-top), F.least(F.lit(top), F.col(f"{evidence}.{c}"))).alias(c) for c, top in LIMITS.items()]


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, toxic).

    Rows with crc32(doc_id) mod 5 = 0, null ids and null labels teach nothing; folds 1 to 3 give the
    class counts, fold 4 the calibration. Null and empty texts have no evidence, so the score of
    evidence 0. Without both classes among the labels the score is the share of toxic ones (0 without
    labels). Repeated rows are scored each. Returns doc_id, held_out, score, predicted and the evidence.
    """
    known = saved(_labelled(docs, labels), "labels")
    model = train(docs, _share(known.filter("fold < 4"), CLASS_ROWS, "toxic"))
    calibrate = _share(known.filter("fold = 4"), CALIBRATION_ROWS)
    some = docs.select("doc_id", "text").join(F.broadcast(calibrate.select("doc_id", "toxic")), "doc_id")
    kept = docs.sparkSession.sparkContext.broadcast(model)
    del model
    found = evidence(kept)
    seen = saved(some.select(F.col("toxic").cast("double").alias("label"), found.alias("e")).select("label", *_inputs("e")), "calibration")
    sizes = {r.label: r.n for r in seen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) == 2:
        rows = VectorAssembler(inputCols=list(LIMITS), outputCol="features").transform(seen)
        fit = LogisticRegression(maxIter=100, regParam=1e-4).fit(rows)
        parts = zip(_inputs("e"), fit.coefficients.toArray().tolist(), strict=True)
        score = 1 / (1 + F.exp(-sum((x * F.lit(k) for x, k in parts), F.lit(float(fit.intercept)))))
    else:
        score = F.lit(sizes.get(1.0, 0) / max(1, sum(sizes.values())))
    held = F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) == 0)
    scored = saved(docs.select("doc_id", held.alias("held_out"), found.alias("e")).withColumn("score", score).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "e.*"), "toxicity")
    kept.destroy()  # a session that scores many tables keeps no old models
    return scored
