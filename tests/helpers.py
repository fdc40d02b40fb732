"""Comparison helpers for tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Iterable


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.10g}")
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def bag(rows: Iterable) -> list:
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


def rows(df) -> list:
    return bag(df.collect())


def same(df, expected: Iterable, columns: str | None = None) -> None:
    if columns is not None:
        assert df.columns == columns.split()
    got, want = rows(df), bag(expected)
    assert got == want, f"{got} != {want}"
