"""Each check on passing and on failing rows."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import bag, rows, same
from txnspark.operators import contracts as C
from txnspark.operators import quality as Q


def ints(spark, *values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def test_accepted_range(spark):
    df = ints(spark, -1, 11, None)
    same(Q.accepted_range(df, "id", -1, 11), [])
    same(Q.accepted_range(df, "id", -1, 11, inclusive=False), [(-1,), (11,)])
    same(Q.accepted_range(df, "id", min_value=0), [(-1,)])
    same(Q.accepted_range(df, "id"), [])
    same(Q.values_between(df, "id", max_value=11, strictly=True), [(11,)])


def test_at_least_one_and_not_constant(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (3, "x"), (3, "y")], "g int, field string")
    same(Q.at_least_one(df, "field"), [])
    same(Q.at_least_one(df, "field", ["g"]), [(2, 0)], "g filler_column")
    same(Q.not_constant(df, "field"), [])
    same(Q.not_constant(df, "field", ["g"]), [(1, 1)], "g filler_column")
    same(Q.not_constant(df.where("g = 2"), "field"), [])


def test_cardinality_equality(spark):
    a, b = ints(spark, 1, 2, 3), ints(spark, 2, 3, 1)
    same(Q.cardinality_equality(a, "id", b, "id"), [])
    same(Q.cardinality_equality(a, "id", ints(spark, 1, 1, 2, 4), "id"), [(1, 1), (1, 2), (3, 1), (4, 1)])


def test_row_counts(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "g int, f string")
    b = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (3, "z")], "g int, f string")
    same(Q.equal_rowcount(a, b), [(3, 4, 1)], "count_a count_b diff_count")
    grouped = Q.equal_rowcount(a, b, ["g"])
    same(grouped, [(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 3, None)], "g_a g_b count_a count_b diff_count")
    assert Q.sum_failures(grouped, "diff_count").first()[0] == 1
    assert Q.sum_failures(Q.fewer_rows_than(a, b), "row_count_delta").first()[0] == 0
    assert Q.sum_failures(Q.fewer_rows_than(a, a), "row_count_delta").first()[0] == 1
    assert Q.sum_failures(Q.fewer_rows_than(b, a), "row_count_delta").first()[0] == 1
    assert Q.sum_failures(Q.fewer_rows_than(b.limit(0), a), "row_count_delta").first()[0] == 0


def test_equality(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "q")], "i int, s string")
    same(Q.equality(a, a), [])
    diff = Q.equality(a, b)
    same(diff, [("b_minus_a", 3, "q")], "which_diff i s")
    assert Q.equality_failures(diff).first()[0] == 2
    assert Q.equality_failures(Q.equality(a, a)).first()[0] == 0


def test_expression_is_true(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 2.0)], "col_a double, col_b double")
    same(Q.expression_is_true(df, "col_a + col_b = 1"), [])
    same(Q.expression_is_true(df, "= 0.5", "col_a"), [(0.0, 1.0), (1.0, 0.0)])


NO_GAPS = [(0, 1), (1, 2), (2, 4)]


def ranges(spark, data):
    return spark.createDataFrame(data, "lower_bound int, upper_bound int")


def test_ranges_modes(spark):
    df = ranges(spark, NO_GAPS)
    for gaps, failures in (("not_allowed", 0), ("allowed", 0), ("required", 2)):
        assert Q.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps=gaps).count() == failures
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="some")


def test_ranges_report_columns(spark):
    got = Q.mutually_exclusive_ranges(ranges(spark, [(0, 3), (2, 4), (9, None), (7, 7)]), "lower_bound", "upper_bound")
    assert got.columns[-2:] == [
        "lower_bound_less_than_upper_bound",
        "upper_bound_less_than_or_equal_to_next_lower_bound",
    ]
    same(got, [(0, 3, 2, False, True, False), (7, 7, 9, False, False, True), (9, None, None, True, False, True)])


def test_ranges_partitioned(spark):
    d = dt.date
    data = [
        (1, d(2019, 1, 1), d(2019, 2, 1)),
        (1, d(2019, 3, 3), d(2019, 4, 1)),
        (2, d(2019, 5, 6), d(2019, 7, 2)),
        (2, d(2019, 7, 3), None),
    ]
    df = spark.createDataFrame(data, "subscription_id int, valid_from date, valid_to date")
    end = "coalesce(valid_to, date'2099-01-01')"
    for gaps in ("allowed", "required"):
        same(Q.mutually_exclusive_ranges(df, "valid_from", end, "subscription_id", gaps), [])
    zero = [
        (3, d(2020, 5, 6), d(2020, 5, 7)),
        (3, d(2020, 5, 8), d(2020, 5, 10)),
        (3, d(2020, 5, 8), d(2020, 5, 8)),
        (3, d(2020, 5, 12), d(2020, 5, 15)),
        (4, d(2020, 6, 6), d(2020, 6, 7)),
        (4, d(2020, 6, 8), d(2020, 6, 8)),
    ]
    df = spark.createDataFrame(zero, "subscription_id int, valid_from date, valid_to date")
    args = (df, "valid_from", "valid_to", "subscription_id")
    assert Q.mutually_exclusive_ranges(*args, zero_length_range_allowed=True).count() == 0
    assert Q.mutually_exclusive_ranges(*args).count() == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_random(spark, duck, seed):
    """A third of the ranges belong to one key; bounds may be NULL and repeat."""
    rng = random.Random(seed)
    data = []
    for _ in range(400):
        k = 0 if rng.random() < 0.34 else rng.randrange(1, 6)
        lo = None if rng.random() < 0.05 else rng.randrange(100)
        data.append((k, lo, None if rng.random() < 0.05 else (lo or 0) + rng.randrange(4)))
    df = spark.createDataFrame(data, "k int, lo int, hi int").repartition(6)
    duck.register("t", pd.DataFrame(data, columns=["k", "lo", "hi"]).astype("Int64"))
    for part, over in (("k", "PARTITION BY k"), (None, "")):
        got = Q.mutually_exclusive_ranges(df, "lo", "hi", part)
        keys = ["partition_by_col"] if part else []
        want = duck.sql(
            f"""SELECT {'k, ' if part else ''} lo, hi, nxt, last FROM (SELECT *,
              lead(lo) OVER ({over} ORDER BY lo NULLS FIRST, hi NULLS FIRST) AS nxt,
              lead(1) OVER ({over} ORDER BY lo NULLS FIRST, hi NULLS FIRST) IS NULL AS last FROM t)
            WHERE NOT (coalesce(lo < hi, false) AND coalesce(hi <= nxt, last, false))"""
        ).fetchall()
        assert rows(got.select(*keys, "lower_bound", "upper_bound", "next_lower_bound", "is_last_record")) == bag(want)


def test_value_lists(spark):
    df = spark.createDataFrame([(1, "Barcelona"), (2, "London"), (3, "Paris"), (4, None)], "id int, city string")
    same(Q.not_accepted_values(df, "city", ["Madrid", "Berlin"]), [])
    same(Q.not_accepted_values(df, "city", ["Paris"]), [("Paris",)], "value_field")
    same(Q.accepted_values(df, "city", ["Paris", "London"]), [("Barcelona", 1)], "value_field n_records")


def test_strings(spark):
    df = spark.createDataFrame([("x",), ("  ",), ("",), (None,)], "s string")
    same(Q.not_empty_string(df, "s"), [("",), ("",)])
    same(Q.not_empty_string(df, "s", trim_whitespace=False), [("",)])
    same(Q.value_lengths_equal(df, "s", 1), [("  ",), ("",)])
    same(Q.not_null(df, "s"), [(None,)])


def test_not_null_proportion(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (3, 2), (4, 2)], "v int, g int")
    same(Q.not_null_proportion(df, "v", 0.75), [])
    same(Q.not_null_proportion(df, "v", 0.8), [(0.75,)])
    same(Q.not_null_proportion(df, "v", 0.6, 0.9, ["g"]), [(1, 0.5), (2, 1.0)])


def test_recency(spark):
    as_of = F.lit(dt.datetime(2024, 1, 10, 12)).cast("timestamp_ntz")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 9)), (2, dt.datetime(2024, 1, 1))], "g int, ts timestamp_ntz")
    same(Q.recency(df, "ts", "day", 1, as_of=as_of).select("most_recent"), [(dt.datetime(2024, 1, 9),)])
    same(Q.recency(df, "ts", "day", 1, True, as_of=as_of), [])
    same(Q.recency(df, "ts", "day", 2, group_by=["g"], as_of=as_of).select("g"), [(2,)])
    same(Q.recency(df.limit(0), "ts", "day", 1, as_of=as_of), [])


def test_relationships(spark):
    child, parent = ints(spark, 1, 2, 4, 4, None), ints(spark, 1, 2, 3, None)
    same(Q.relationships_where(child, "id", parent, "id", "id <> 4"), [], "id right_id")
    same(Q.relationships_where(child, "id", parent, "id"), [(4, None), (4, None)])
    same(Q.relationships(child, "id", parent, "id"), [(4,), (4,)], "from_field")
    same(Q.relationships_where(child, "id", parent, "id", to_condition="id <> 2").select("id"), [(2,), (4,), (4,)])


def test_relationships_hot_orphan(spark):
    child = spark.range(25_001).selectExpr("7 AS id")
    assert Q.relationships(child, "id", spark.range(3).toDF("id"), "id").count() == 25_001


def test_sequential_values(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, my_even_sequence int")
    same(Q.sequential_values(df, "my_even_sequence", 2), [], "my_even_sequence previous_my_even_sequence")
    same(Q.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"]), [])
    odd = ints(spark, 1, 2, 2, 5, None, name="v")
    same(Q.sequential_values(odd, "v"), [(2, 2), (5, 2)])
    hours = spark.createDataFrame([(dt.datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "ts timestamp_ntz")
    same(Q.sequential_values(hours, "ts", 1, "hour").select("ts"), [(dt.datetime(2021, 1, 1, 4),)])


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, None), (2, "b")], "i int, s string")
    same(Q.unique(df, "s"), [], "unique_field n_records")
    same(Q.unique(df, "i"), [(1, 3)])
    same(Q.unique_combination_of_columns(df, ["i", "s"]), [(1, None)], "i s")


def test_assert_equal_and_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "a int, b int")
    assert Q.assert_equal(df, "a", "b").count() == 1
    assert Q.assert_equal(df, "a", "b", null_safe=True).count() == 2
    assert Q.columns_match_set(df, ["A", "b"]) == set()
    assert Q.columns_match_set(df, ["a", "c"]) == {"B", "C"}


def test_runner_thresholds(spark):
    df = ints(spark, 1, 2, 3, None)
    too_big = lambda d: Q.accepted_range(d, "id", max_value=1)
    got = Q.run_checks(
        df,
        [
            Q.Check("plain", too_big),
            Q.Check("strict", too_big, severity="error"),
            Q.Check("loose", too_big, severity="error", error_if="> 5", warn_if="> 1"),
            Q.Check("filtered", too_big, where="id < 2"),
            Q.Check("sum", lambda d: Q.equal_rowcount(d, d.limit(1)), failures=lambda v: Q.sum_failures(v, "diff_count")),
        ],
    )
    same(
        got,
        [
            ("plain", 2, "warn", "warn"),
            ("strict", 2, "error", "error"),
            ("loose", 2, "error", "warn"),
            ("filtered", 0, "warn", "pass"),
            ("sum", 3, "warn", "warn"),
        ],
        "check failures severity status",
    )
    with pytest.raises(ValueError):
        Q.Check("bad", too_big, severity="fatal").outcome(df)


GOOD = {
    "transaction_id": "123e4567-e89b-12d3-a456-426614174000",
    "user_id": 5,
    "amount": 10.5,
    "currency": "USD",
    "merchant_id": "123e4567-e89b-12d3-a456-426614174001",
    "merchant_name": "Shop",
    "merchant_category": "Retail",
    "card_type": "Visa",
    "timestamp": "2024-01-01T00:00:00Z",
    "location_country": "US",
    "location_city": "Boston",
    "latitude": 42.0,
    "longitude": -71.0,
}


def test_transaction_contract(spark):
    from txnspark.schemas import TRANSACTION_MESSAGE

    bad = {
        "currency": "usd", "amount": 0.0, "user_id": 0, "latitude": 91.0, "card_type": "Cash", "merchant_id": "m1",
        "timestamp": "yesterday", "location_country": "USA", "merchant_category": "Toys", "longitude": -181.0,
    }
    data = [GOOD] + [GOOD | {k: v} for k, v in bad.items()] + [GOOD | {"merchant_name": None}]
    df = spark.createDataFrame([tuple(r[f] for f in TRANSACTION_MESSAGE.fieldNames()) for r in data], TRANSACTION_MESSAGE)
    valid, rejected = C.split_valid(df, C.transaction_rules())
    assert valid.count() == 1 and valid.columns == TRANSACTION_MESSAGE.fieldNames()
    got = sorted(r[0] for r in rejected.select(F.explode("violations")).collect())
    assert [g.split(":")[0] for g in got] == sorted([*bad, "merchant_name"])
    assert C.violation_counts(df, C.transaction_rules()).count() == len(bad) + 1


def test_other_contracts(spark):
    from txnspark.schemas import EXCHANGE_RATE_MESSAGE, INDICATOR_MESSAGE

    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    fresh, old = "2024-01-01T12:00:00+00:00", "2023-12-30T00:00:00+00:00"
    rates = spark.createDataFrame(
        [("USD", "EUR", 0.9, 1, fresh, fresh), ("USD", "eur", -1.0, 1, old, fresh)], EXCHANGE_RATE_MESSAGE
    )
    counts = {r["rule"]: r["failures"] for r in C.violation_counts(rates, C.exchange_rate_rules(now)).collect()}
    assert set(counts) == {"target_currency: pattern", "rate: minimum", "api_timestamp_iso_utc: age"}
    status = {r["check"]: r["failures"] for r in Q.run_checks(rates, C.exchange_rate_expectations(now)).collect()}
    assert status == {"rate >= 0": 1, "base currency code": 0, "target currency code": 1, "timestamp not older than 24 h": 1}
    ind = spark.createDataFrame(
        [("t", "GDP", "n", 1.0, "d", "US", "daily", "s"), ("t", "GDP", "n", float("nan"), "d", "USA", "weekly", "s")],
        INDICATOR_MESSAGE,
    )
    assert C.split_valid(ind, C.indicator_rules())[0].count() == 1
    assert [r["failures"] for r in Q.run_checks(ind, C.indicator_expectations()).collect()] == [1, 1, 1]


def test_checks_read_the_frame_once_per_kind(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 2.0), (1, "b", -1.0), (None, "c", None), (3, None, 5.0)], "id int, s string, v double").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [
        Q.Check("unique", Q.unique_rule("id"), "error"),
        Q.Check("combination", Q.unique_combination_rule(["id", "s"])),
        Q.Check("values", Q.values_rule("s", ["a"])),
        Q.Check("forbidden", Q.forbidden_rule("s", ["b", "x"]), where="v > 0"),
        Q.Check("positive", Q.range_rule("v", min_value=0), "error", error_if="> 1", warn_if="between 1 and 5"),
        Q.Check("not null", Q.not_null_rule("id"), where="v IS NULL"),
        Q.Check("length", Q.length_rule("s", 1)),
        Q.Check("other", lambda d: Q.at_least_one(d, "v", ["s"])),
    ]
    got = Q.run_checks(df, checks)
    found = {r["check"]: (r["failures"], r["status"]) for r in got.collect()}
    assert found == {c.name: tuple(c.outcome(df).select("failures", "status").first()) for c in checks}
    assert found["unique"] == (1, "error") and found["positive"] == (1, "warn") and found["values"] == (2, "warn") and found["forbidden"] == (0, "pass")
    plan = Q.run_checks(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3  # rows, keys and the one of another kind
