"""Parquet table access for the driver-provided star schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of ``sf_dir``; column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BASE_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def register_views(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Expose the base tables to ``spark.sql`` under their own names."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
