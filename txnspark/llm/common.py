"""Helpers shared by the operators: words, one-time bindings, stored intermediate tables, free column names."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.session import ensure_checkpoint_dir



def worker_code(module: str) -> None:
    """Send the functions of a module to the Python workers by value, so that the cluster need not install the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


# A word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, so that other scripts keep their letters. ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(_lower_letters(text))


def _lower_letters(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def body_hash(text: Column) -> Column:
    """Tells texts of one id apart, and texts without an id."""
    return F.xxhash64(F.coalesce(text, F.lit("\0")))


def scratch(spark: SparkSession, name: str) -> str:
    """New path in the folder that all executors share."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows up to which a side that has been counted may be broadcast.
BROADCAST_ROWS = 1_000_000


def meet(left: DataFrame, right: DataFrame, on, how: str = "inner", bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join with the right side broadcast if counting shows at most ``bound`` rows, else by shuffles. ``right`` should be
    stored, as it is read twice."""
    small = right.limit(bound + 1).count() <= bound
    return left.join(F.broadcast(right) if small else right.hint("merge"), on, how)
