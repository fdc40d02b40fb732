"""Date and time helpers (FN-24 .. FN-30, GEN-03)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_part(part: str) -> str:
    part = part.lower()
    if part not in PARTS:
        raise ValueError(f"unknown date part {part!r}")
    return part


def add_interval(part: str, amount: Column | int, ts: Column | str) -> Column:
    """FN-27: timestamp shifted by a number of date parts."""
    return F.timestamp_add(check_part(part).upper(), F.lit(amount) if isinstance(amount, int) else amount, _col(ts))


def intervals_between(part: str, start: Column | str, end: Column | str) -> Column:
    """GEN-03: number of part boundaries from start to end (day: midnights, month: month starts)."""
    part = check_part(part)
    start, end = _col(start), _col(end)
    if part == "day":
        return F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return F.timestamp_diff(part.upper(), F.date_trunc(part, start), F.date_trunc(part, end))


def months_between_whole(start: Column | str, end: Column | str) -> Column:
    """FN-26: whole months from start to end."""
    return F.timestamp_diff("MONTH", _col(start), _col(end))


def local_wall_clock(ts: Column | str, zone: str) -> Column:
    """FN-25: wall-clock time of a UTC instant in a zone."""
    return F.from_utc_timestamp(_col(ts), zone).cast("timestamp_ntz")


def iso_utc(unix_seconds: Column | str) -> Column:
    """FN-30: unix seconds as ISO-8601 text with offset."""
    return F.date_format(F.timestamp_seconds(_col(unix_seconds)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
