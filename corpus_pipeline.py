"""Training-corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the columns of
``documents``; the last also returns copy and position. Between stages the rows are stored in the shared folder.

Defined results: NULL and empty texts fail the quality rules; texts are read whole, however long; of equal or linked texts
the one with the smallest id stays (NULL after all others); rows of one id, or without one, are judged each by its text; a
text that loses all lines stays as the empty text and is never taken by the mix; an empty table gives no rows; extra
columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnspark.llm import decontaminate, line_dedup, mixing, quality_rules, shingle_join
from txnspark.llm.common import stored
from txnspark.session import configure


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_rules.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return line_dedup.drop_repeated(docs, count="n_chars")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return shingle_join.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmarks),
    ("source_mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


# Line templates and connected groups cannot be stated in one SQL query; tests/llm/test_pipeline.py plants cases for every
# stage and recomputes the shares of the mix, and the stages' operators have brute-force tests of their own.
ORACLE_SQL = None
