"""Small results for the driver (AGG-10 .. AGG-12). Every collect is bounded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COLLECTED = 100_000


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """AGG-10 as a frame (value, n): distinct values, by default most frequent first, ties by value."""
    source = df.where(where) if where else df
    counted = source.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.orderBy(*(order_by or [F.desc("n"), F.asc("value")]))
    return ranked.limit(max_records) if max_records is not None else ranked


def get_column_values(
    df: DataFrame | None,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    default: list | None = None,
    where: str | None = None,
    bound: int | None = None,
) -> list:
    """AGG-10: the values as a list; ``default`` serves a missing relation or an empty result.

    ``max_records`` keeps the first so many. A list of more than ``bound`` values (``MAX_COLLECTED``) is an error,
    never a shorter list.
    """
    bound = MAX_COLLECTED if bound is None else bound
    if df is None:
        if default is None:
            raise ValueError("the relation does not exist and no default was given")
        return default
    fetch = bound + 1 if max_records is None else min(max_records, bound + 1)
    rows = column_values(df, column, order_by, fetch, where).select("value").collect()
    if len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} values; use column_values")
    return [r[0] for r in rows] or (default if default is not None else [])


def get_single_value(df: DataFrame, default: object = None) -> object:
    """AGG-11: first cell, or ``default`` when the result is empty."""
    row = df.first()
    return default if row is None else row[0]


def get_results_as_dict(df: DataFrame, bound: int | None = None) -> dict[str, list]:
    """AGG-12: columns of a small result as lists; more than ``bound`` (``MAX_COLLECTED``) rows are an error."""
    bound = MAX_COLLECTED if bound is None else bound
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} rows")
    return {c: [r[i] for r in rows] for i, c in enumerate(df.columns)}
