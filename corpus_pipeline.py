"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage reads what its predecessor kept; all but the last return the columns
of ``documents``. ``run`` writes every stage as Parquet to the shared folder and
rereads it for the next one, so a lost executor costs at most one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehound.llm import decontam, langid, linededup, neardup, packing
from lakehound.llm.shared import code_on_workers, saved, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; those without a letter (also null and empty texts) go."""
    code_on_workers(spark)
    small_batches(spark)
    found = langid.predicted(spark, langid.learn(docs), F.col("text"))
    return docs.select(*COLUMNS, found["lang_pred"].alias("__lang")).filter(F.col("__lang") != langid.UNDETERMINED).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 code points in three documents or more stay in the largest doc_id only."""
    code_on_workers(spark)
    small_batches(spark)
    out = linededup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (similarity 0.8 or more) stays, the one with the smallest doc_id.

    Texts without a word link with nothing and stay. Rows that repeat a doc_id stay or go together;
    rows with a null doc_id stay.
    """
    code_on_workers(spark)
    small_batches(spark)
    gone = neardup.near_duplicates(docs, percent=80, bands=neardup.BANDS_80).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (similarity 0.8 or more) go; rows with a null doc_id stay."""
    code_on_workers(spark)
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontam.find_leaks(docs, benchmark).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, neighbours on the Hilbert curve together."""
    code_on_workers(spark)
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Suffix automata, SimHash and tokenizers are no SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
