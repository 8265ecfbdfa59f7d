"""Time windows and time formats, all relative to one explicit run time.

Bounds are computed once on the driver and become literals, so Parquet
row-group and partition pruning apply to every log scan.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_TZ = "Asia/Tokyo"


def as_utc(moment: datetime) -> datetime:
    """A naive time is read as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def local_midnight(as_of: datetime, tz: str = DEFAULT_TZ, days_back: int = 0) -> datetime:
    """UTC instant of the local midnight ``days_back`` days before ``as_of``."""
    local = as_utc(as_of).astimezone(ZoneInfo(tz))
    day = local.date() - timedelta(days=days_back)
    return datetime.combine(day, time.min, ZoneInfo(tz)).astimezone(timezone.utc)


def window_bounds(spec: str, as_of: datetime, tz: str = DEFAULT_TZ) -> tuple[datetime, datetime]:
    """Half-open UTC bounds of ``-Nd`` (whole days), ``-Nd/now`` or ``0d/now``."""
    head, _, tail = spec.partition("/")
    if not head.endswith("d") or tail not in ("", "now"):
        raise ValueError(f"unknown interval: {spec!r}")
    days = -int(head[:-1])
    if days < 0:
        raise ValueError(f"interval must look back: {spec!r}")
    start = local_midnight(as_of, tz, days)
    end = as_utc(as_of) if tail == "now" else local_midnight(as_of, tz)
    return start, end


def ts_lit(moment: datetime) -> Column:
    """Timestamp literal of an instant, whatever the session time zone."""
    return F.timestamp_micros(F.lit(round(as_utc(moment).timestamp() * 1_000_000)))


def in_range(
    df: DataFrame, start: datetime | None, end: datetime | None, ts: str = "ts"
) -> DataFrame:
    """Rows with ``start <= ts < end``; either bound may be open."""
    if start is not None:
        df = df.filter(F.col(ts) >= ts_lit(start))
    if end is not None:
        df = df.filter(F.col(ts) < ts_lit(end))
    return df


def in_window(
    df: DataFrame, spec: str, as_of: datetime, tz: str = DEFAULT_TZ, ts: str = "ts"
) -> DataFrame:
    return in_range(df, *window_bounds(spec, as_of, tz), ts=ts)


def epoch(ts: Column | str) -> Column:
    """Whole epoch seconds of a timestamp column."""
    return F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)


def age_days(ts: Column | str, as_of: datetime) -> Column:
    return (F.lit(int(as_utc(as_of).timestamp())) - epoch(ts)) / F.lit(86400.0)


def local_format(ts: Column | str, pattern: str, tz: str = DEFAULT_TZ) -> Column:
    """Text of an instant in a named zone; the session zone must be UTC."""
    return F.date_format(F.from_utc_timestamp(ts, tz), pattern)


def local_text(as_of: datetime, fmt: str, tz: str = DEFAULT_TZ) -> str:
    return as_utc(as_of).astimezone(ZoneInfo(tz)).strftime(fmt)
