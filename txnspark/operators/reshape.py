"""Pivot, unpivot, union of unlike frames, deduplication (AGG-08, AGG-09, SET-02, SET-04)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.functions.scalar import slugify

# Fixed value: default name of the source column of a union.
SOURCE_COLUMN = "_dbt_source_relation"

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def pivot_columns(
    column: str,
    values: Sequence[object],
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | object = 1,
    else_value: Column | object = 0,
    distinct: bool = False,
    slug: bool = False,
) -> list[Column]:
    """AGG-09: one conditional aggregate per value, for ``groupBy(...).agg(*pivot_columns(...))``.

    An absent value yields ``else_value`` (0), unlike ``groupBy().pivot()``, which yields NULL. With ``alias=False``
    Spark names the columns; ``slug`` turns values into plain identifiers.
    """

    def literal(value: Column | object) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    out = []
    for value in values:
        hit = F.when(_COMPARE[cmp](F.col(column), F.lit(value)), literal(then_value)).otherwise(literal(else_value))
        cell = F.call_function(agg, hit) if not distinct else _distinct(agg, hit)
        name = slugify(str(value)) if slug else str(value)
        out.append(cell.alias(f"{prefix}{name}{suffix}") if alias else cell)
    return out


def _distinct(agg: str, value: Column) -> Column:
    functions = {"sum": F.sum_distinct, "count": F.count_distinct}
    if agg in functions:
        return functions[agg](value)
    if agg in ("min", "max"):
        return F.call_function(agg, value)
    raise ValueError(f"distinct is not supported with {agg!r}")


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """SET-04: one row per (row, column); ``exclude`` columns are kept, ``remove`` dropped, NULL cells stay."""
    kept = {c.lower() for c in exclude}
    gone = {c.lower() for c in remove}
    fields = [f for f in df.schema.fields if f.name.lower() not in kept | gone]
    cells = [
        (F.col(f.name).cast("string") if isinstance(f.dataType, T.BooleanType) else F.col(f.name))
        .cast(cast_to)
        .alias(f.name)
        for f in fields
    ]
    ids = [c for c in df.columns if c.lower() in kept]
    return df.select(*ids, *cells).unpivot(ids, [f.name for f in fields], field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """SET-02: UNION ALL of named frames over the superset of their columns in first-seen order; names compare without case.

    A column has the type it had where it was first seen, or the overriding type; a frame that lacks it adds NULLs.
    ``where`` filters every branch before the union, so it reaches each scan.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    included, excluded = {c.lower() for c in include}, {c.lower() for c in exclude}
    override = {c.lower(): t for c, t in (column_override or {}).items()}

    def wanted(name: str) -> bool:
        return name.lower() in included if included else name.lower() not in excluded

    types: dict[str, tuple[str, T.DataType | str]] = {}
    for frame in relations.values():
        for field in frame.schema.fields:
            if wanted(field.name):
                key = field.name.lower()
                types.setdefault(key, (field.name, override.get(key, field.dataType)))
    if not types:
        raise ValueError(f"no columns to union for {', '.join(relations)}")

    def branch(name: str, frame: DataFrame) -> DataFrame:
        present = {c.lower() for c in frame.columns}
        source = [F.lit(name).alias(source_column_name)] if source_column_name else []
        cells = [
            (F.col(f"`{c}`") if key in present else F.lit(None)).cast(t).alias(c) for key, (c, t) in types.items()
        ]
        return (frame.where(where) if where else frame).select(*source, *cells)

    return reduce(DataFrame.union, [branch(name, frame) for name, frame in relations.items()])


def deduplicate(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[str | Column]) -> DataFrame:
    """AGG-08: first row per key in the given order.

    Spark prunes to one row per key and task before the shuffle (WindowGroupLimit), so a hot key costs no more than
    the number of map tasks.
    """
    first = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("_rank", first).where(F.col("_rank") == 1).drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """AGG-08 as an aggregate: the row with the greatest ``order`` per key, NULL being the lowest; ties go by a hash of the row."""
    rest = [c for c in df.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(F.col(order), F.xxhash64(*rest))).alias("_top")
    return df.groupBy(*keys).agg(top).select(*keys, "_top.*").select(*df.columns)
