"""Golden tables of the frame operators."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import bag, rows, same
from txnspark.operators import columns, generators, reshape, values


@pytest.fixture(scope="module")
def sizes(spark):
    return spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")


def test_pivot_fills_zero(sizes):
    same(sizes.groupBy("size").agg(*reshape.pivot_columns("color", ["red", "blue"])), [("S", 1, 1), ("M", 1, 0)], "size red blue")


def test_pivot_apostrophe_slug(sizes):
    found = values.get_column_values(sizes, "color", order_by=[F.asc("value")])
    df = sizes.groupBy("size").agg(*reshape.pivot_columns("color", found, slug=True))
    same(df.select("size", "red", "blue", "blues"), [("S", 1, 1, 1), ("M", 1, 0, 0)])


def test_pivot_options(sizes):
    df = sizes.groupBy("size").agg(
        *reshape.pivot_columns("color", ["red"], cmp="!=", prefix="not_", suffix="_n"),
        *reshape.pivot_columns("color", ["red"], agg="count", then_value=F.col("color"), else_value=None, distinct=True, prefix="d_"),
    )
    same(df, [("S", 2, 1), ("M", 0, 1)], "size not_red_n d_red")
    plain = sizes.groupBy("size").agg(*reshape.pivot_columns("color", ["red"], alias=False))
    assert plain.columns[1] != "red"
    with pytest.raises(ValueError):
        reshape.pivot_columns("color", ["red"], agg="avg", distinct=True)


def test_unpivot(spark):
    df = spark.createDataFrame(
        [(123, dt.date(2017, 1, 1), "active", "tier 1", True), (567, dt.date(2017, 3, 1), "churned", "tier 2", None)],
        "customer_id int, created_at date, status string, segment string, is_updated boolean",
    )
    got = reshape.unpivot(df, "string", ["customer_id", "CREATED_AT"], ["segment"], "prop", "val")
    same(
        got,
        [
            (123, dt.date(2017, 1, 1), "status", "active"),
            (123, dt.date(2017, 1, 1), "is_updated", "true"),
            (567, dt.date(2017, 3, 1), "status", "churned"),
            (567, dt.date(2017, 3, 1), "is_updated", None),
        ],
        "customer_id created_at prop val",
    )
    assert reshape.unpivot(df, exclude=["customer_id", "created_at"]).columns[2:] == ["field_name", "value"]


def _tables(spark):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    return {"t1": one, "t2": two}


UNION = [
    (1, "drew", "pi", None),
    (2, "bob", "e", None),
    (3, "alice", "4", None),
    (1, None, "7", "green"),
    (2, None, "13", "pink"),
]


def test_union_relations(spark):
    got = reshape.union_relations(_tables(spark))
    assert got.columns == ["_dbt_source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(got.drop("_dbt_source_relation")) == bag(UNION)
    assert rows(got.groupBy("_dbt_source_relation").count()) == [("t1", 3), ("t2", 2)]


def test_union_relations_compares_names_without_case(spark):
    a, b = spark.sql("select 1 as ID, 'x' as name"), spark.sql("select 2 as id, 'y' as Name, 3 as n")
    got = reshape.union_relations({"a": a, "b": b}, source_column_name=None, column_override={"id": "bigint"})
    same(got, [(1, "x", None), (2, "y", 3)], "ID name n")
    assert got.schema["ID"].dataType.simpleString() == "bigint"


def test_union_relations_options(spark):
    t = _tables(spark)
    got = reshape.union_relations(t, exclude=["NAME"], source_column_name=None, where="id > 1", column_override={"id": "string"})
    assert dict(got.dtypes)["id"] == "string"
    same(got, [("2", "e", None), ("3", "4", None), ("2", "13", "pink")], "id favorite_number favorite_color")
    assert reshape.union_relations(t, include=["Id"], source_column_name="src").columns == ["src", "id"]
    with pytest.raises(ValueError):
        reshape.union_relations(t, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations(t, include=["nothing"])


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    same(reshape.deduplicate(df.where("user_id = 1"), ["user_id", "event"], [F.desc("version")]), [(1, "play", 2)])
    same(reshape.latest_by(df, ["user_id", "event"], "version"), [(1, "play", 2), (2, "pause", 1)], "user_id event version")


def test_deduplicate_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = reshape.deduplicate(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_star_and_columns(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*columns.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*columns.star(df, prefix="prefix_", suffix="_suffix")).columns[0] == "prefix_field_1_suffix"
    assert columns.star(df, df.columns) == []
    assert columns.filtered_columns(df, ["Field_1"]) == ["field_2", "field_3"]
    agg = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g1 string, g2 string, v int")
    same(agg.groupBy(*columns.star(agg, ["v"])).agg(F.sum("v")), [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)])
    same(columns.group_by_first(agg, 1).agg(F.count(F.lit(1))), [("a", 2), ("c", 2)])
    with pytest.raises(ValueError):
        columns.group_by_first(agg, 4)


def test_nullcheck(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "f1 string, f2 string, f3 int")
    same(columns.nullcheck_table(df), [("a", None, 1), (None, "b", 2), (None, None, 3)], "f1 f2 f3")
    assert df.select(*columns.nullcheck(df, ["f1"])).columns == ["f1"]


def test_generators(spark):
    same(generators.generate_series(spark, 10), [(i,) for i in range(1, 11)], "generated_number")
    with pytest.raises(ValueError):
        generators.generate_series(spark, 0)
    days = [(dt.date(2018, 1, d),) for d in range(1, 10)]
    same(generators.date_spine(spark, "day", "2018-01-01", "2018-01-10"), days, "date_day")
    same(generators.date_spine(spark, "month", "2018-01-15", "2018-04-15"), [(dt.date(2018, m, 15),) for m in (1, 2, 3)])
    assert generators.date_spine(spark, "hour", "2018-01-01", "2018-01-02").count() == 24
    assert generators.date_spine(spark, "day", "2018-01-01", "2018-01-01").count() == 0


def test_column_values(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string")
    assert values.get_column_values(df, "field") == ["g", "a", "b", "c", "d", "e", "f"]
    assert values.get_column_values(df, "field", [F.asc("value")], max_records=2) == ["a", "b"]
    assert values.get_column_values(df, "field", where="field < 'c'") == ["a", "b"]
    assert values.get_column_values(df, "field", where="field = 'z'", default=["y"]) == ["y"]
    assert values.get_column_values(None, "field", default=["y"]) == ["y"]
    with pytest.raises(ValueError):
        values.get_column_values(None, "field")


def test_column_values_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(values, "MAX_COLLECTED", 3)
    with pytest.raises(ValueError):
        values.get_column_values(spark.range(5), "id")


def test_single_value_and_dict(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], "col_1 int, col_2 string, col_3 boolean")
    assert values.get_single_value(df.orderBy("col_1").select("col_2")) == "a"
    assert values.get_single_value(df.where("col_1 > 9"), default=7) == 7
    got = values.get_results_as_dict(df.orderBy("col_1"))
    assert got == {"col_1": [1, 2, 3], "col_2": ["a", "b", "c"], "col_3": [True, False, None]}


def test_latest_by_is_the_same_for_any_order_of_rows(spark):
    from txnspark.operators import reshape

    rows = [(1, 5, "x"), (1, 5, "y"), (2, None, "z")]
    got = {frozenset(map(tuple, reshape.latest_by(spark.createDataFrame(r, "k int, o int, v string"), ["k"], "o").collect())) for r in (rows, rows[::-1])}
    assert len(got) == 1 and (2, None, "z") in next(iter(got))


def test_values_are_all_there_or_an_error(spark):
    import pytest

    from txnspark.operators import values

    df = spark.range(50).selectExpr("id as v")
    assert len(values.get_column_values(df, "v", max_records=50, bound=60)) == 50
    with pytest.raises(ValueError, match="more than 20"):
        values.get_column_values(df, "v", max_records=50, bound=20)
