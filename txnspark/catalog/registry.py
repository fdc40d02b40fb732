"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: zone-less timestamps, doubles for decimals, no wrapped arrays."""
    casts = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double"}
    columns = [
        F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*columns)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the equivalent SQL over the test tables."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(configure(spark), sf_dir.rstrip("/")))

        _QUERIES[name] = run
        if oracle:
            _ORACLES[name] = oracle
        return run

    return register


def ctes(*parts: str) -> str:
    """WITH clause of the given named subqueries."""
    return "WITH " + ", ".join(parts) + " "


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
