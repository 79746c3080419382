"""Top-k (L1-L7): ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject,
each task keeps its own k best rows and one merge picks the final k.
The key is always the last sort column so the cut is stable under ties."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, ts: str, k: int) -> DataFrame:
    """The rows of the newest hours that together hold ``k`` rows (all rows if there are fewer).

    A large top-k by ``ts`` then takes its rows from those hours only, not k rows from every
    task of the table.
    """
    cut = time_cut(df, ts, k)
    return df.filter(cut.isNull() | (F.col(ts) >= cut))


def time_cut(df: DataFrame, ts: str, k: int, newest_first: bool = True) -> Column:
    """The hour from which on (or up to which) ``df`` holds at least ``k`` rows, as a scalar sub-query; NULL if it holds fewer.

    Hours are counted first: one row each in the ordered window.
    """
    hour = F.col("_hour").desc() if newest_first else F.col("_hour").asc()
    through = Window.orderBy(hour).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hours = df.filter(F.col(ts).isNotNull()).groupBy(F.date_trunc("hour", ts).alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    enough = hours.withColumn("_sum", F.sum("_n").over(through)).filter(F.col("_sum") >= k)
    return enough.agg((F.max if newest_first else F.min)("_hour")).scalar()


def newest_joined(df: DataFrame, ts: str, k: int, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``join(df)`` over only as many of the newest hours of ``df`` as give ``k`` joined rows, or all.

    The join sees few rows where most find a partner; where too few do, four times as many rows are
    taken. No joined row outside the hours taken is newer than one inside, so a top-k by ``ts`` is exact.
    """
    want = k
    while True:
        cut = df.sparkSession.range(1).select(time_cut(df, ts, want).alias("cut")).first().cut
        if cut is None:
            return join(df)
        rows = join(df.filter(F.col(ts) >= F.lit(cut)))
        if rows.limit(k).count() == k:
            return rows
        want *= 4


def top_k(df: DataFrame, order: Sequence, k: int, tie_keys: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``order`` (Columns or names, names sort descending)."""
    cols: list[Column] = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    cols += [F.col(t).asc() for t in tie_keys]
    return df.orderBy(*cols).limit(k)
