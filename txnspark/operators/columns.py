"""Column-list operators (STG-08 .. STG-10, AGG-07)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """STG-09: column names without the excluded ones (case-insensitive)."""
    dropped = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, exclude: Iterable[str] = (), prefix: str = "", suffix: str = "") -> list[Column]:
    """STG-08: projection of all but the excluded columns, renamed only when a prefix or suffix is given."""
    names = filtered_columns(df, exclude)
    if not (prefix or suffix):
        return [df[c] for c in names]
    return [df[c].alias(f"{prefix}{c}{suffix}") for c in names]


def nullcheck(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """STG-10: projection with empty strings as NULL; other types pass."""
    chosen = set(columns) if columns is not None else set(df.columns)
    return [
        F.nullif(df[f.name], F.lit("")).alias(f.name)
        if f.name in chosen and isinstance(f.dataType, T.StringType)
        else df[f.name]
        for f in df.schema.fields
        if f.name in chosen
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """STG-10 for a whole frame."""
    return df.select(*nullcheck(df))


def group_by_first(df: DataFrame, n: int):
    """AGG-07: group by the first n columns."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"n must be in 1..{len(df.columns)}")
    return df.groupBy(*df.columns[:n])
