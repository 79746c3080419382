"""Places, running totals and k-th rows of ordered groups, without bringing a group into one task.

Rows are range-sorted by (group, order): Spark samples the keys, so every partition holds about
equally many rows, whatever the groups' sizes and however the values crowd. A partition runs through
its own rows; the totals of the partitions before it, a table of about one row a partition and
group, shift them. The sorted rows are written once, since a range sort that is run twice may cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.session import saved


def _cumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``_part`` and ``_before``, the ``_value`` of the same group's earlier rows in this partition."""
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("_group").to_numpy(zero_copy_only=False)
        value = batch.column("_value").to_numpy(zero_copy_only=False)
        before = np.cumsum(value) - value
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        before = before - np.repeat(before[head], np.diff(np.append(head, len(group))))
        if last is not None and group[0] == last:
            before[:head[1] if len(head) > 1 else len(group)] += carried
        last, carried = group[-1], before[-1] + value[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(group), part, np.int32)), pa.array(before)],
                                         names=[*batch.schema.names, "_part", "_before"])


def ranged(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows sorted by ``by`` over all partitions, which hold about equally many each."""
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def running_total(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``, the sum of ``value`` (a long or double without nulls) over the group's rows before this one by ``order``.

    Groups are null-safe; ``order`` must tell rows apart where ties matter, and NULLs come first.
    """
    kind = df.select(value.alias("v")).schema["v"].dataType
    rows = df.withColumn("_group", F.xxhash64(*[F.struct(F.col(c)) for c in groups]) if groups else F.lit(0).cast("long")).withColumn("_value", value)
    rows = ranged(rows, ["_group", *order])
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_before", kind)])
    table = saved(rows.mapInArrow(_cumulated, schema), "running-total")
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = table.groupBy("_group", "_part").agg(F.sum("_value").alias("_sum")).select(
        "_group", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    out = table.join(shifts, ["_group", "_part"])
    return out.withColumn(name, (F.col("_before") + F.col("_shift")).cast(kind)).drop("_group", "_value", "_part", "_before", "_shift")


def with_place(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """Add ``name``, a row's place (from 0) in its group by ``order``."""
    return running_total(df, groups, order, F.lit(1).cast("long"), name)


def kth(df: DataFrame, group: str, hash_: str, key: str, ranks: DataFrame, digits: int = 3, steps: int = 2) -> DataFrame:
    """Per ``group`` the (hash, key) of its k-th smallest row: (group, cut), ``ranks`` giving (group, k).

    ``hash_`` is a hex text. Each step counts rows by ``digits`` more digits of it (a partial
    aggregate), finds the range that holds the k-th row and goes on inside that range alone; what is
    left after all ``steps``, about one row in 16 ** (digits * steps), is sorted. Groups with k < 1
    have no cut.
    """
    left = ranks.select(F.col(group).alias("_of"), F.col("k").alias("_k"), F.lit("").alias("_start")).filter("_k >= 1")
    same = F.col(group).eqNullSafe(F.col("_of"))
    rows = df.select(group, hash_, key)
    for step in range(steps):
        width = digits * (step + 1)
        inside = rows.join(left, same & F.col(hash_).startswith(F.col("_start")))
        counts = inside.groupBy("_of", "_k", F.substring(hash_, 1, width).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
        through = Window.partitionBy("_of").orderBy("_range")
        counts = counts.withColumn("_through", F.sum("_n").over(through))
        # a table of one row a group, written so that the next step does not count again
        left = saved(counts.filter((F.col("_through") >= F.col("_k")) & (F.col("_through") - F.col("_n") < F.col("_k"))).select(
            "_of", (F.col("_k") - F.col("_through") + F.col("_n")).alias("_k"), F.col("_range").alias("_start")), "kth")
    place = Window.partitionBy("_of").orderBy(hash_, key)
    inside = rows.join(left, same & F.col(hash_).startswith(F.col("_start"))).withColumn("_place", F.row_number().over(place))
    return inside.filter(F.col("_place") == F.col("_k")).select(F.col("_of").alias(group), F.struct(hash_, key).alias("cut"))
