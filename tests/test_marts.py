"""Staging, marts, views and dashboards on small frames."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import rows, same
from txnspark import schemas as S
from txnspark.plans import cards, dashboards, staging, star

GOOD = {
    "transaction_id": "t1", "user_id": 5, "amount": 10.5, "currency": "USD", "merchant_id": "m1", "merchant_name": "Shop",
    "merchant_category": "Retail", "card_type": "Visa", "timestamp": "2024-06-01T00:00:00Z", "location_country": "US",
    "location_city": "Boston", "latitude": 42.0, "longitude": -71.0,
}


def envelopes(spark, *bodies):
    data = [(b if isinstance(b, str) else json.dumps(b), '{"CreateTime":"2024-06-01T00:00:05Z"}') for b in bodies]
    return spark.createDataFrame(data, S.RAW_ENVELOPE)


def test_stage_transactions(spark):
    raw = envelopes(
        spark,
        GOOD,
        GOOD | {"user_id": "7", "amount": "0.01"},
        GOOD | {"user_id": 0},
        GOOD | {"amount": 10000.01},
        GOOD | {"currency": "USDX"},
        GOOD | {"location_country": "us"},
        GOOD | {"card_type": None},
        GOOD | {"merchant_id": {"d": 1}},
        "not json",
    )
    staged = staging.stage_transactions(raw)
    assert staged.columns == [
        "transaction_id", "user_id", "amount", "currency", "merchant_id", "merchant_name", "merchant_category", "card_type",
        "timestamp", "location_country", "location_city", "latitude", "longitude", "transaction_timestamp_local",
        "transaction_date_utc",
    ]
    assert dict(staged.dtypes)["amount"] == "decimal(38,9)"
    got = staged.select("user_id", "merchant_id", "transaction_timestamp_local", "transaction_date_utc").collect()
    assert sorted((r[0], r[1] or "") for r in got) == [(5, ""), (5, "m1"), (7, "m1")]
    assert {r[2] for r in got} == {dt.datetime(2024, 6, 1, 3)} and {r[3] for r in got} == {dt.date(2024, 6, 1)}
    failed = rows(staging.rejected_transactions(raw).select(F.concat_ws(",", "failed_rules")))
    assert ("user_id",) in failed and ("currency",) in failed and len(failed) == 6
    assert staging.stage_transactions(raw, max_amount="20000").count() == 4


def test_envelope_is_parsed_once(spark):
    plan = staging.stage_transactions(envelopes(spark, GOOD))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_stage_indicators(spark):
    raw = envelopes(spark, {"indicator_id": "GDP", "indicator_name": "n", "value": "1.5", "date": "2024-01-01", "country": "US"},
                    {"indicator_id": "X", "value": ".", "date": "bad"})
    same(
        staging.stage_indicators(raw),
        [("GDP", "n", 1.5, dt.date(2024, 1, 1), "US"), ("X", None, None, None, None)],
        "indicator_id indicator_name value date country",
    )
    odd = envelopes(spark, {"indicator_id": "[A] b", "indicator_name": {"d": 1}, "value": [1], "country": "{x}"})
    same(staging.stage_indicators(odd).drop("value", "date"), [("[A] b", None, "{x}")])


def test_dim_date(spark):
    d = star.dim_date(spark)
    assert d.count() == 2192
    sunday = d.where("date_id = date'2023-01-01'").first()
    assert tuple(sunday)[2:] == (2023, 1, 1, 1, 1, 1, "January", "Sunday")


@pytest.fixture(scope="module")
def staged(spark):
    renamed = GOOD | {"transaction_id": "t2", "merchant_name": "New name", "user_id": 6}
    elsewhere = GOOD | {"transaction_id": "t3", "location_city": None, "timestamp": "2031-01-01T00:00:00Z"}
    return staging.stage_transactions(envelopes(spark, GOOD, renamed, elsewhere)).cache()


def test_fact_does_not_fan_out(spark, staged):
    fct = star.fct_transactions(
        staged, star.dim_date(spark), star.dim_users(staged), star.dim_merchants(staged), star.dim_location(staged)
    )
    assert fct.columns == ["transaction_id", "date_key", "user_key", "merchant_key", "location_key", "amount", "currency"]
    assert star.dim_merchants(staged).count() == 2
    day = dt.date(2024, 6, 1)
    # A NULL city matches no place; a day outside the calendar has no key.
    same(
        fct.drop("amount"),
        [("t1", day, 5, "m1", "US", "USD"), ("t2", day, 6, "m1", "US", "USD"), ("t3", None, 5, "m1", None, "USD")],
    )


def test_dimensions(spark, staged):
    assert star.dim_location(staged, with_key=True).select("location_sk").distinct().count() == 2
    users = star.dim_users(staged)
    assert users.columns == ["user_id", "created_at"] and users.select("created_at").distinct().count() == 1


def test_fraud_view_without_attributes(spark, staged):
    series = spark.createDataFrame(
        [("unemployment_rate", dt.date(2024, 6, 1), 4.0), ("gdp", dt.date(2024, 6, 1), 9.0)], "indicator_name string, date date, value double"
    )
    view = star.fraud_analysis_view(staged, star.dim_users(staged), staged.select("merchant_id").distinct(), series)
    got = rows(view.select("transaction_id", "unemployment_rate", "credit_score", "is_fraud", "transaction_day_of_week"))
    assert got == [("t1", 4.0, None, None, 7), ("t2", 4.0, None, None, 7), ("t3", None, None, None, 4)]
    features = star.ml_features_view(view)
    assert features.columns[-4:] == ["use_chip", "transaction_count_last_24h", "avg_amount_last_7d", "is_fraud"]
    assert sorted(r["transaction_count_last_24h"] for r in features.collect()) == [1, 1, 2]


@pytest.fixture(scope="module")
def warehouse(spark):
    ts = dt.datetime
    t = spark.createDataFrame(
        [
            (1, 10, 100, 7, "Reno", "NV", "89501", 95.0, True, ts(2024, 1, 1, 10)),
            (2, 10, 100, 8, None, None, None, 75.0, False, ts(2024, 1, 2, 9)),
            (3, 11, 101, 7, "Reno", "NV", "89501", 1.0, True, ts(2024, 1, 2, 10)),
            (4, 10, 100, 7, "Reno", "NV", "89501", 1.0, True, None),
        ],
        S.RAW_TRANSACTIONS,
    )
    c = spark.createDataFrame(
        [(100, 10, "Visa", "Debit", "4000111122223333", "12/30", "123", False, 1, 100.0), (101, 11, "Amex", "Credit", "3711", "01/31", None, True, 2, 6000.0)],
        S.RAW_CARDS,
    )
    u = spark.createDataFrame(
        [(10, 29, 1995, 2, "Female", "a", 0.0, 0.0), (11, None, None, 1, "Male", "b", 10.0, 10.0)], S.RAW_USERS
    )
    m = spark.createDataFrame([(7, "Reno", "NV", "89501", 0.0, 1.0)], "merchant_id long, merchant_city string, merchant_state string, zip string, merchant_latitude double, merchant_longitude double")
    i = spark.createDataFrame(
        [("UNRATE", dt.date(2024, 1, 1), 4.0, "monthly", "US"), ("UNRATE", dt.date(2024, 1, 2), 5.0, "monthly", "US"), ("XX", dt.date(2024, 1, 2), 0.0, "daily", "US"), ("XX", dt.date(2024, 1, 3), 1.0, "daily", "US")],
        S.RAW_INDICATORS,
    )
    labels = spark.createDataFrame([(1, True), (2, False)], S.RAW_FRAUD_LABELS)
    return t, c, u, m, i, labels


def as_of():
    return F.lit("2024-03-01 10:00:00").cast("timestamp_ntz")


def test_card_marts(spark, warehouse):
    marts = cards.build_marts(*warehouse, as_of=as_of())
    facts = marts.fact_transactions
    same(
        facts.select("transaction_id", "risk_level", "card_usage_anomaly", "months_since_transaction", "merchant_city"),
        [(1, "High", "Anomaly", 2, "Reno"), (2, "Medium", "Normal", 1, None), (3, "Low", "Normal", 1, "Reno")],
    )
    same(
        marts.fact_economic_indicators.select("indicator", "indicator_name", "value", "previous_value", "change_rate"),
        [
            ("UNRATE", "Unemployment Rate", 4.0, None, None),
            ("UNRATE", "Unemployment Rate", 5.0, 4.0, 0.25),
            ("XX", None, 0.0, None, None),
            ("XX", None, 1.0, 0.0, None),
        ],
    )
    view = marts.fraud_analysis_view
    same(
        view.select("transaction_id", "daily_transaction_count", "unemployment_rate", "is_fraud", F.round("distance_to_merchant", -3)),
        [(1, 1, 4.0, True, 111000.0), (2, 2, 5.0, False, None), (3, 1, 5.0, None, 1493000.0)],
    )
    assert marts.ml_features.columns == [*cards.FEATURE_COLUMNS, "transaction_date"]
    assert "months_since_transaction" not in view.columns


def test_card_dimensions(spark, warehouse):
    t, c, u, *_ = warehouse
    same(
        cards.dim_users(u).select("user_id", "age_group", "birth_date"),
        [(10, "Young", dt.datetime(1995, 2, 1)), (11, "Senior", None)],
    )
    same(
        cards.dim_cards(c).select("card_id", "card_number", "cvv", "credit_limit_category"),
        [(100, "************3333", "***", "Low"), (101, "************3711", None, "High")],
    )
    assert cards.dim_cards(c, mask=False).where("cvv = '123'").count() == 1
    same(cards.dim_merchants(t), [(7, "Reno", "NV", "89501", "Reno, NV")])


def test_write_marts(spark, warehouse):
    for _ in range(2):
        marts = cards.write_marts(*warehouse, as_of=as_of())
        assert spark.table("fact_transactions").count() == 3
        assert spark.table("ml_features").count() == marts.ml_features.count() == 3
        assert marts.dim_users.count() == 2
    # The views read the stored tables: a row added to one shows.
    series = spark.table("fact_economic_indicators")
    again = series.where(F.col("indicator") == cards.UNEMPLOYMENT)
    spark.createDataFrame(again.collect(), series.schema).write.insertInto("fact_economic_indicators")
    assert spark.table("fraud_analysis_view").count() > 3


def test_dashboards(spark):
    ts = dt.datetime
    data = [(ts(2024, 1, d, 5), 1 + d % 2, float(d), d % 3 == 0) for d in range(1, 41 - 9) for _ in range(d)]
    df = spark.createDataFrame(data, "transaction_date timestamp_ntz, client_id int, amount double, is_fraud boolean")
    now = F.lit(ts(2024, 1, 31)).cast("timestamp_ntz")
    got = dashboards.transaction_dashboard(df, now).collect()
    assert len(got) == 30 and got[0]["date"] == dt.date(2024, 1, 31)
    assert got[0].asDict() | {"date": None} == {
        "date": None, "transaction_count": 31, "total_amount": 961.0, "avg_amount": 31.0, "unique_users": 1, "daily_change": 3.33,
    }
    fraud = dashboards.fraud_dashboard(df, now).collect()
    assert len(fraud) == 7
    assert [r["fraud_rate"] for r in fraud] == [0.0, 100.0, 0.0, 0.0, 100.0, 0.0, 0.0]
    assert [r["daily_change"] for r in fraud][:2] == [-100.0, None]


def test_economic_dashboard_filters_before_lag(spark, warehouse):
    facts = cards.fact_economic_indicators(warehouse[4])
    got = dashboards.economic_dashboard(facts, F.lit(dt.date(2024, 1, 3)), days=1)
    same(
        got.select("date", "indicator_name", "value", "percentage_change", "previous_value"),
        [(dt.date(2024, 1, 2), "Unemployment Rate", 5.0, 25.0, None), (dt.date(2024, 1, 2), None, 0.0, None, None), (dt.date(2024, 1, 3), None, 1.0, None, 0.0)],
    )


def test_registered_facts_find_all_their_keys(spark, tmp_path):
    from txnspark.catalog import registered

    events = "event_id bigint, user_id bigint, value double, event_type string, ts timestamp_ntz"
    data = [(i, u, 5.0, "view", dt.datetime(2024, 1, i, 3)) for i, u in ((1, 10), (2, 11), (4, 3), (5, 20), (6, 12), (9, 13))]
    spark.createDataFrame(data, events).write.parquet(str(tmp_path / "events.parquet"))
    facts = registered()["fct_01_transactions"](spark, str(tmp_path))
    want = [(str(i), ts.date(), u, f"m{i}", ["US", "GB", "FR"][i % 3]) for i, u, _, _, ts in data]
    same(facts.select("transaction_id", "date_key", "user_key", "merchant_key", "location_key"), want)


def test_marts_are_published_from_transactions_computed_once(spark, monkeypatch):
    from txnspark.catalog import marts, registered

    class Seen(Exception):
        pass

    def stop(raw, cards, users, merchants, *_):
        raise Seen(raw, merchants)

    monkeypatch.setattr(marts.cards, "write_marts", stop)
    with pytest.raises(Seen) as caught:
        registered()["pipe_01_published_marts"](spark, "/root/testdata/sf0.001")
    for df in caught.value.args:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert df.count() > 0 and "Join" not in plan and "Aggregate" not in plan
