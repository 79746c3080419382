"""Aggregations.

All of them are hash aggregates with a partial (map-side) step, so a hot
group costs one row per map task in the shuffle, whatever its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehound.functions.scalar import minute_of


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A1: one row with the count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, cond, name: str = "n") -> DataFrame:
    """A2: conditional count (``countIf``)."""
    return df.agg(F.count_if(_c(cond)).alias(name))


def distinct_count(df: DataFrame, c, name: str = "n") -> DataFrame:
    """A3: exact distinct count (two-level aggregate, distinct keys pre-combined)."""
    return df.agg(F.countDistinct(_c(c)).alias(name))


def per_minute(df: DataFrame, ts, by: Sequence[str] = (), time_name: str = "time",
               **aggs: Column) -> DataFrame:
    """Group by minute (and extra keys), ordered by time."""
    g = df.groupBy(minute_of(ts).alias(time_name), *by).agg(
        *[v.alias(k) for k, v in aggs.items()])
    return g.orderBy(time_name, *by)


def last_not_null(df: DataFrame, t: str, v: str, name: str | None = None) -> DataFrame:
    """Value at the newest time among rows where it is not NULL.

    Ties on time go to the larger value, so the answer does not depend on order.
    """
    return (df.filter(F.col(v).isNotNull())
            .agg(F.max_by(F.col(v), F.struct(F.col(t), F.col(v))).alias(name or v)))


def to_series(df: DataFrame, time: str, key: str, value: str, keys: Sequence[str],
              fill=None, other: str = "other") -> DataFrame:
    """Long (time, key, value) to one column per key value.

    The key values are passed in, so the pivot needs no extra distinct pass.
    Values of all other keys, NULL too, are summed in the column ``other``.
    """
    names = [*keys, other]
    known = F.when(F.col(key).isin(list(keys)), F.col(key)).otherwise(F.lit(other))
    out = df.withColumn(key, known).groupBy(time).pivot(key, names).agg(F.sum(F.col(value)))
    if fill is not None:
        out = out.fillna(fill, subset=names)
    return out.orderBy(time)


def class_count(df: DataFrame, label: str, name: str = "n_classes") -> DataFrame:
    """Number of distinct labels."""
    return df.agg(F.countDistinct(F.col(label)).alias(name))


def last_by(df: DataFrame, key: str, t: str, values: Sequence[str]) -> DataFrame:
    """Per key, the values of the row with the newest ``t``.

    One ``max_by`` over a struct, so all values come from the same row even when
    times tie; the struct ends with the values themselves to make ties stable.
    """
    packed = F.struct(F.col(t).alias("_t"), *[F.col(v) for v in values])
    best = F.max_by(packed, packed).alias("_last")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_last.{v}").alias(v) for v in values])


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One (table, n) row per named frame, concatenated."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def confusion(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """Count per (predicted, actual) pair."""
    return df.groupBy(F.col(pred).alias("predicted"), F.col(actual).alias("actual")) \
        .agg(F.count(F.lit(1)).alias("n")).orderBy("predicted", "actual")
