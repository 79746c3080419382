"""Versioned reads: one row per key.

``row_number() == 1`` over a key window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so each map
task already cuts every key to one row: a key holding a third of all rows
does not reach one reducer whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    out = []
    for o in order:
        out.append(F.col(o).desc() if isinstance(o, str) else o)
    return out


def latest_by_key(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Keep the row with the largest version per key.

    ``order`` is a version column name (sorted descending) or a list of sort
    columns; give a total order (X1) so the pick never depends on arrival.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1)
            .drop("_rn"))


def first_by_key(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """D3: first-seen row per key; ``order`` ascending (e.g. arrival sequence)."""
    if isinstance(order, str):
        order = [F.col(order).asc()]
    return latest_by_key(df, keys, order)


def max_version_row(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """D2 as an aggregate: ``max_by`` of the whole row by version (partial agg, skew-safe)."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(version)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, "_row.*")
