"""The registered queries of the training-data operators, each over its whole table.

``ORACLE`` has DuckDB SQL where SQL can express the result; the tests hold the
others against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakehound.llm import alignment, decontam, langid, licenses, merkle, neardup, packing, privacy, quality, sharding, toxicity, urlfilter
from lakehound.llm import sql as S
from lakehound.llm.linededup import line_dedup_digest
from lakehound.llm.shared import code_on_workers, small_batches

#: The URL rules of op 1.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    code_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_url_filter", S.URL_FILTER)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), rules)


@register("op4_quality_rules", S.QUALITY)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@register("op6_line_dedup", S.LINE_DEDUP)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(table(spark, sf_dir, "documents"))


@register("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_near_duplicates", S.NEAR_DUPLICATES)
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@register("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


@register("op12_merkle_manifest", S.MERKLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@register("op13_private_data")
def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find_private(table(spark, sf_dir, "documents"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top, deleted together with this subpackage
    return corpus_pipeline.run(spark, sf_dir)
