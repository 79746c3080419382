"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only for a local master without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lakehound-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return str(base).rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def code_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where the package is not installed (``--py-files`` does it on a cluster): workers
    started from another folder would not find it.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


#: Rows of whole texts that the JVM and a Python worker exchange at once.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Exchange fewer rows at once than Spark's default, whose batches of whole texts take tens of MB on both sides of each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_kept: dict = {}


def worker_forgets() -> None:
    """Free what an operator before has left in this Python worker, which outlives its stage."""
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def worker_keeps(key: object, build: Callable[[], object]) -> object:
    """The one large object that a Python worker keeps from task to task: what the operator that it works for now has built."""
    if key not in _kept:
        worker_forgets()
        _kept[key] = build()
    return _kept[key]
