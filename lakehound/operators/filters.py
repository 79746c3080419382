"""Row filters (P4-P7, P11): all plain predicates, pushed to the scan where possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows whose key is NULL."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def time_filter(df: DataFrame, c, lo=None, hi=None) -> DataFrame:
    """P5: closed interval ``lo <= c <= hi``; an open end is not filtered."""
    col = _c(c)
    if lo is not None:
        df = df.filter(col >= _ts(lo))
    if hi is not None:
        df = df.filter(col <= _ts(hi))
    return df


def latest_time(df: DataFrame, c) -> Column:
    """Newest value of ``c`` as a scalar sub-query (one aggregate pass, no driver round trip)."""
    return df.agg(F.max(_c(c))).scalar()


def recent(df: DataFrame, c, interval: str, as_of=None) -> DataFrame:
    """Rows with ``c > as_of - interval``; ``as_of`` defaults to now.

    ``interval`` is a SQL interval literal body such as ``'30 SECONDS'`` or
    ``'7 DAYS'``. ``as_of`` may be a literal, a Column or ``"max"`` for the
    newest value in ``df`` (used when replaying stored data).
    """
    if as_of is None:
        ref = F.current_timestamp()
    elif isinstance(as_of, str) and as_of == "max":
        ref = latest_time(df, c)
    else:
        ref = _ts(as_of)
    return df.filter(_c(c) > ref - F.expr(f"INTERVAL {interval}"))


def between(value: Column, ends: Sequence[float]) -> Column:
    """``value`` lies between two ends, given in any order."""
    return value.between(min(ends), max(ends))


def bbox_filter(df: DataFrame, bbox, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points inside the box of two opposite corners (lat, lon, lat, lon); when none are, the whole input.

    The fallback is decided per row from a one-row flag (``exists`` as a
    scalar sub-query), so no count reaches the driver.
    """
    if bbox is None:
        return df
    corners = [float(x) for x in bbox]
    inside = between(F.col(lat), corners[0::2]) & between(F.col(lon), corners[1::2])
    any_inside = df.filter(inside).exists()
    return df.filter(inside | ~any_inside)


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])
