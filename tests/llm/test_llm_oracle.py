"""Registered training-data queries against their oracle SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from helpers import bag, rows

SF = os.environ.get("TXNSPARK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents pages benchmark labels conversations".split()

if not os.path.isdir(SF):
    pytest.skip("no test tables", allow_module_level=True)

import __spark_entry__ as driver  # noqa: E402
from txnspark.llm import queries as llm  # noqa: E402

# Neither line templates, connected groups, lattices, byte strings nor page trees can be stated in SQL: these are tested
# against brute force elsewhere.
WITHOUT = {
    "op5_ngram_jaccard_join", "op6_lm_scoring", "op8_benchmark_decontamination", "op9_secret_scans", "op10_html_extraction", "op11_suffix_array_dedup",
}


def test_the_driver_has_all_of_them():
    assert set(llm.registered()) - set(llm.oracles()) == WITHOUT and set(llm.oracles()) <= set(llm.registered())
    assert {*llm.registered(), "pipeline"} <= set(driver.queries()) and set(llm.oracles()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.oracles()))
def test_query(spark, name):
    import duckdb

    df = llm.registered()[name](spark, SF)
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        result = con.execute(llm.oracles()[name])
        names = [d[0] for d in result.description]
        order = sorted(df.columns)
        assert order == sorted(names)
        want = bag(tuple(r[names.index(c)] for c in order) for r in result.fetchall())
    assert rows(df.select(*[f"`{c}`" for c in order])) == want
