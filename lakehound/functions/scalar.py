"""Column functions (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results (congestion level limits, units).
# Speed limits for the congestion level, km/h: below 12 congested (2), below 24 slow (1).
CONGESTED_BELOW = 12.0
SLOW_BELOW = 24.0
MPH_TO_KMH = 1.60934
EARTH_RADIUS_M = 6371000.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_log(c) -> Column:
    """natural log of 1 + amount."""
    return F.log1p(_c(c))


def in_zone(c, tz: str | None = None) -> Column:
    """UTC wall clock as the wall clock of zone ``tz``; unchanged without one."""
    return _c(c) if tz is None else F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(c).cast("timestamp_ntz"))


def hour_of(c, tz: str | None = None) -> Column:
    """hour of day, of a UTC time in zone ``tz`` if one is given."""
    return F.hour(in_zone(c, tz))


def dow_sun1(c, tz: str | None = None) -> Column:
    """weekday with Sunday = 1 .. Saturday = 7, in zone ``tz`` if one is given."""
    return F.dayofweek(in_zone(c, tz))


def dow_mon1(c, tz: str | None = None) -> Column:
    """weekday with Monday = 1 .. Sunday = 7, in zone ``tz`` if one is given."""
    return F.weekday(in_zone(c, tz)) + 1


def minute_of(c) -> Column:
    """timestamp truncated to the minute."""
    return F.date_trunc("minute", _c(c))


def parse_ts(c) -> Column:
    """lenient timestamp parse; unparseable text gives NULL instead of an error."""
    return F.try_to_timestamp(_c(c))


def to_utc(c, tz: str = "UTC") -> Column:
    """wall-clock timestamp in zone ``tz`` to UTC."""
    return F.to_utc_timestamp(_c(c), tz)


def from_millis(c) -> Column:
    """epoch milliseconds to timestamp."""
    return F.timestamp_millis(_c(c))


def congestion_level(speed) -> Column:
    """2 below 12 km/h, 1 below 24 km/h, else 0, also for a NULL speed."""
    s = _c(speed)
    return (F.when(s < CONGESTED_BELOW, F.lit(2))
            .when(s < SLOW_BELOW, F.lit(1))
            .otherwise(F.lit(0)))


def decision(p, threshold: float = 0.5) -> Column:
    """P10: label 1 when the probability reaches the threshold."""
    return (_c(p) >= threshold).cast("int")


def parse_maxspeed(raw, road_type, defaults: Column) -> Column:
    """first number in the text, mph converted to km/h, else the type default.

    ``defaults`` is the per-road-type default speed column (from the road-type
    dimension, already falling back to the global default).
    """
    r = _c(raw).cast("string")
    num = F.regexp_extract(r, r"(\d+)", 1)
    val = F.when(num != "", num.cast("double"))
    val = F.when(F.lower(r).contains("mph"), val * MPH_TO_KMH).otherwise(val)
    return F.coalesce(F.when(r.isNotNull() & (r != ""), val), defaults)


def parse_highway(raw) -> Column:
    """first word of a road-type value (lists allowed), else ``unknown``."""
    r = _c(raw).cast("string")
    w = F.regexp_extract(r, r"([a-zA-Z_]+)", 1)
    return F.when(r.isNull() | (w == ""), F.lit("unknown")).otherwise(w)


def link_id(src, dst, key=None) -> Column:
    """``src_dst`` or ``src_dst_key`` when the edge key is present."""
    if key is None:
        return F.concat_ws("_", _c(src), _c(dst))
    return F.concat_ws("_", _c(src), _c(dst), _c(key))


def row_id(*cols) -> Column:
    """row id; random when no columns are given, else a stable digest of them."""
    if not cols:
        return F.expr("uuid()")
    return F.sha2(F.concat_ws("\u0001", *[_c(c).cast("string") for c in cols]), 256)


def clamp(c, lo: float, hi: float) -> Column:
    """limit a value to [lo, hi]."""
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def round_half_up(c, n: int) -> Column:
    """F8: round to ``n`` decimals, ties away from zero, on the decimal value.

    The double is first fixed to 10 decimals (DECIMAL(38,10)), so noise in the
    last bits of an average cannot move a tie such as 0.3085 either way.
    """
    return F.round(_c(c).cast("decimal(38,10)"), n).cast("double")
