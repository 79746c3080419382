"""Append-only logs with a total order, and tables published as versioned folders behind a pointer.

A log is a folder with a folder for each entry, so that writers at once never meet in one. An entry carries ``seq``, one more than
the largest its writer saw, and a random ``id``; (seq, id) orders all entries, whatever the clocks
say. Two writers at once may take one ``seq``: the order between them is then that of their ids, and
both entries stay. Whatever refers to an entry refers to its ``id``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = [T.StructField("seq", T.LongType()), T.StructField("id", T.StringType())]
POINTER = T.StructType([*ORDER, T.StructField("path", T.StringType())])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows where nothing was ever written; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """All entries of a log; those still being written are not seen."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(log)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_entry(rows: DataFrame, log: str) -> None:
    """Add ``rows`` to a log as one entry."""
    rows.coalesce(1).write.parquet(os.path.join(log, uuid.uuid4().hex))


def newest(value: str) -> Column:
    """Aggregate: ``value`` of the last entry."""
    return F.max_by(value, F.struct("seq", "id"))


def append_entry(spark: SparkSession, log: str, schema: T.StructType, /, **fields) -> str:
    """Add an entry behind all that this writer sees; returns its id. ``schema`` begins with ORDER."""
    seq = (read_log(spark, log, schema).agg(F.max("seq")).first()[0] or 0) + 1
    entry = {"seq": seq, "id": uuid.uuid4().hex, **fields}
    write_entry(spark.createDataFrame([tuple(entry[f.name] for f in schema)], schema), log)
    return entry["id"]


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version of the table at ``root`` and point readers to it; returns its folder.

    The pointer moves only after all files are there. Older folders stay, so a reader that began
    before goes on with the rows it began with.
    """
    path = os.path.join(root, "data", f"v-{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    append_entry(df.sparkSession, os.path.join(root, "pointer"), POINTER, path=path)
    return path


def current_path(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest version, or None before the first."""
    return read_log(spark, os.path.join(root, "pointer"), POINTER).agg(newest("path")).first()[0]


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest version of the table at ``root``, as it is now."""
    path = current_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no version at {root}")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
