"""Warehouse tables: partitioned append, incremental load, materialisation, lookup by name (SRC-05 .. SRC-10, SRC-16)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.operators.reshape import union_relations
from txnspark.session import scratch_path


def append(df: DataFrame, table: str, path: str | None = None) -> None:
    """SRC-05, SRC-08: append to a table, created when missing (at ``path`` as an external table)."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def lay_out_by_day(df: DataFrame, ts: str = "timestamp", cluster: str = "user_id", day: str = "day") -> DataFrame:
    """Add the day and place rows for a day-partitioned, clustered write.

    The rows of a day go to tasks of about the advisory partition size: AQE cuts a busy day into several and joins quiet
    ones, whatever share of the rows a day has. Rows are sorted by the cluster column, which makes its row-group
    statistics selective.
    """
    return df.withColumn(day, F.to_date(ts)).hint("rebalance", day).sortWithinPartitions(day, cluster)


def append_by_day(
    df: DataFrame, table: str, ts: str = "timestamp", cluster: str = "user_id", day: str = "day", path: str | None = None
) -> None:
    """SRC-06: append to a table partitioned by day and clustered by a column (at ``path`` as an external table)."""
    writer = lay_out_by_day(df, ts, cluster, day).write.mode("append").format("parquet").option("compression", "snappy")
    (writer.option("path", path) if path else writer).partitionBy(day).saveAsTable(table)


def append_bucketed(df: DataFrame, table: str, buckets: int, cluster: str = "user_id") -> None:
    """SRC-06 for tables that are joined on the cluster column: equal buckets join without a shuffle."""
    df.write.mode("append").format("parquet").bucketBy(buckets, cluster).sortBy(cluster).saveAsTable(table)


def high_water_mark(spark: SparkSession, table: str, ts: str = "timestamp"):
    """SRC-07: newest timestamp of a table, None when it is missing or empty."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table).agg(F.max(ts)).first()[0]


def newer_than(source: DataFrame, mark, ts: str = "timestamp") -> DataFrame:
    """SRC-07: rows after the high-water mark; all rows when there is none."""
    return source if mark is None else source.where(F.col(ts) > F.lit(mark).cast(source.schema[ts].dataType))


def _same(names: Sequence[str], left: str = "a", right: str = "b") -> Column:
    """Equal values, NULL equal to NULL, of two aliased frames."""
    return reduce(Column.__and__, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in names])


def _in_days(day: str, days: Sequence) -> Column:
    """Literal days, so that the scan reads their folders alone; NULL is the folder of rows without a time."""
    return F.col(day).isin([d for d in days if d is not None]) | (F.col(day).isNull() if None in days else F.lit(False))


def _days(df: DataFrame, day: str) -> list:
    """Distinct days: a bounded list, at most one per folder of the table."""
    return [r[0] for r in df.select(day).distinct().collect()]


def load_increment(
    source: DataFrame,
    table: str,
    ts: str = "timestamp",
    cluster: str = "user_id",
    day: str = "day",
    key: Sequence[str] | None = None,
    path: str | None = None,
    keys_move: bool = False,
) -> list:
    """SRC-06, SRC-07: merge an increment into the days that it touches; returns the days rewritten.

    ``key`` names a row (all columns if not given); the increment's row replaces the table's, and of several in the
    increment the one with the newest time (then the greatest other columns) counts. Only folders of days in which
    something is new or other than before are rewritten, so late rows of any age and rows without a time load once, and a
    second run writes nothing. The merged days are stored before the table changes: a load that fails half-way is
    repeated from its source and nothing of the old days is lost. ``keys_move`` also looks for the keys on other days, at
    the price of reading the key columns of the whole table. The reference computes a mark and ignores it; every run
    appends everything again.
    """
    spark = source.sparkSession
    ids = list(key or source.columns)
    rest = [c for c in source.columns if c not in ids]
    newest = F.max(F.struct(*dict.fromkeys([c for c in (ts, *rest) if c in rest]))) if rest else F.lit(None)
    one = source.groupBy(*ids).agg(newest.alias("_row"))
    one = one.select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in source.columns]).withColumn(day, F.to_date(ts))
    if not spark.catalog.tableExists(table):
        append_by_day(one.drop(day), table, ts, cluster, day, path)
        return sorted(_days(spark.table(table), day), key=str)
    held = spark.table(table)
    columns = held.columns
    same_days = held.where(_in_days(day, _days(one, day)))
    changed = one.select(*columns).alias("a").join(same_days.alias("b"), _same(columns), "left_anti")
    changed = stored(changed, "changed-rows")
    days = _days(changed, day)
    if not days:
        return []
    if keys_move:
        moved = held.where(~_in_days(day, days) | F.col(day).isNull()).alias("a").join(changed.alias("b"), _same(ids), "left_semi")
        days = list({*days, *_days(moved, day)})
    kept = held.where(_in_days(day, days)).alias("a").join(changed.alias("b"), _same(ids), "left_anti")
    merged = stored(kept.unionByName(changed), "merged-days")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        # A day that all rows have left is emptied by hand: the overwrite only touches days with rows.
        for empty in set(days) - set(_days(merged, day)):
            value = "NULL" if empty is None else f"DATE'{empty}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = {value})")
        lay_out_by_day(merged, ts, cluster, day).select(*columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    return sorted(days, key=str)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as files next to the checkpoints, so that what reads it several times computes it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def copy_table(spark: SparkSession, source: str, target: str, path: str | None = None) -> None:
    """SRC-08: raw table appended to the transformed table."""
    append(spark.table(source), target, path)


def read_source(spark: SparkSession, path: str, view: str) -> DataFrame:
    """SRC-09: raw envelope files under a view name."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(view)
    return df


def materialise(df: DataFrame, name: str, kind: str = "view", sort_by: Sequence[str] = (), partition_by: Sequence[str] = (), root: str | None = None):
    """SRC-10, SORT-02, SORT-03: replace a view, or a stored table laid out in the given order within its files.

    With ``root`` the table is published by version (``publish``); without, Spark's own overwrite replaces it in place.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"kind must be 'view' or 'table', got {kind!r}")
    if root:
        return publish({name: store_version(df, f"{root}/{name}", sort_by, partition_by)}, df.sparkSession)[name]
    laid_out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = laid_out.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def store_version(df: DataFrame, folder: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> str:
    """SRC-10: write a frame to a new folder of its own below ``folder``; nothing that is read now changes."""
    version = f"{folder}/version={uuid.uuid4().hex}"
    laid_out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = laid_out.write.format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(version)
    return version


def publish(versions: dict[str, str], spark: SparkSession) -> dict[str, DataFrame]:
    """SRC-10: point names at stored versions, when all of them are written.

    A name is a view over one version's folder, and replacing a view is one change of the catalog: a query reads the old
    version or the new one, never a folder half-written or just deleted, and a reader that began before goes on with the
    old files. Old versions stay until their folders are removed.
    """
    for name, folder in versions.items():
        old = spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"
        if old:
            raise ValueError(f"{name} is a table; drop it before publishing versions under its name")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return {name: spark.table(name) for name in versions}


def _like(pattern: str) -> re.Pattern:
    """SQL LIKE pattern, case-insensitive."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def _tables(spark: SparkSession, schema_pattern: str) -> Iterator[tuple[str, str]]:
    schema = _like(schema_pattern)
    for database in spark.catalog.listDatabases():
        if schema.fullmatch(database.name):
            for table in spark.catalog.listTables(database.name):
                if table.namespace:
                    yield database.name, table.name


def relations_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "") -> list[str]:
    """SRC-16: names of the catalog tables whose schema and name match LIKE patterns."""
    name, skip = _like(table_pattern), _like(exclude) if exclude else None
    return sorted(
        f"{db}.{t}"
        for db, t in _tables(spark, schema_pattern)
        if name.fullmatch(t) and not (skip and skip.fullmatch(t))
    )


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    """SRC-16: names of the catalog tables that start with a prefix."""
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_tables(spark: SparkSession, names: Sequence[str], **options) -> DataFrame:
    """SRC-16 feeding SET-02."""
    return union_relations({n: spark.table(n) for n in names}, **options)
