"""File scans and Parquet sinks (SRC-01 .. SRC-05, SRC-11, SRC-17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAKE_PARTITIONS = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour")]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """SRC-01, SRC-11: CSV with header. Without a schema the types are inferred, which reads the file twice."""
    reader = spark.read.option("header", True).option("nullValue", "").option("emptyValue", "")
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """SRC-02: JSON documents."""
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_lake(
    spark: SparkSession, path: str, schema: T.StructType, where: str | Column | None = None
) -> DataFrame:
    """SRC-03: JSON lines under year=/month=/day=/hour= folders; ``where`` on those columns prunes folders."""
    full = T.StructType(schema.fields + LAKE_PARTITIONS.fields)
    lake = spark.read.schema(full).option("multiLine", False).json(path)
    return lake.where(where) if where is not None else lake


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """SRC-04: Parquet sink, snappy."""
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType | None = None) -> None:
    """SRC-01: load of one CSV dataset."""
    write_parquet(read_csv(spark, source, schema), target)


def json_to_parquet(
    spark: SparkSession, source: str, target: str, schema: T.StructType | None = None, multiline: bool = False
) -> None:
    """SRC-02: load of one JSON dataset."""
    write_parquet(read_json(spark, source, schema, multiline), target)


def load_datasets(spark: SparkSession, raw: str, out: str, schemas: dict[str, T.StructType] | None = None) -> None:
    """SRC-01, SRC-02: the five raw datasets, each overwritten as Parquet."""
    known = schemas or {}
    for name in ("transactions", "users", "cards"):
        csv_to_parquet(spark, f"{raw}/{name}.csv", f"{out}/{name}", known.get(name))
    for name in ("fraud_labels", "mcc_codes"):
        json_to_parquet(spark, f"{raw}/{name}.json", f"{out}/{name}", known.get(name))


def constant_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """SRC-17: literal rows."""
    return spark.createDataFrame(list(rows), schema)


def with_day(df: DataFrame, ts: str, out: str) -> DataFrame:
    """Day column to partition a table by."""
    return df.withColumn(out, F.to_date(ts))
