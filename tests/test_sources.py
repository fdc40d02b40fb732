"""File and table sources and sinks, feeds, lookup by name."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, same
from txnspark import schemas as S
from txnspark.sources import feeds, files, tables


def test_csv_and_json_loads(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    (raw / "transactions.csv").write_text("id,amount,city\n1,2.5,Reno\n2,,\n")
    (raw / "users.csv").write_text("id,current_age\n1,30\n")
    (raw / "cards.csv").write_text("id,card_brand\n1,Visa\n")
    (raw / "fraud_labels.json").write_text('{"transaction_id":1,"is_fraud":true}\n')
    (raw / "mcc_codes.json").write_text('{"code":"5411","name":"Grocery"}\n')
    files.load_datasets(spark, str(raw), str(out), {"fraud_labels": S.RAW_FRAUD_LABELS})
    t = spark.read.parquet(str(out / "transactions"))
    assert dict(t.dtypes) == {"id": "int", "amount": "double", "city": "string"}
    same(t, [(1, 2.5, "Reno"), (2, None, None)])
    same(spark.read.parquet(str(out / "fraud_labels")), [(1, True)])
    assert dict(files.read_csv(spark, str(raw / "transactions.csv"), "id long, amount double, city string").dtypes)["id"] == "bigint"
    # A second load overwrites.
    files.load_datasets(spark, str(raw), str(out))
    assert spark.read.parquet(str(out / "users")).count() == 1


def test_json_lake_prunes_folders(spark, tmp_path):
    lake = str(tmp_path / "lake")
    data = [(str(i), 2024, 1, 1 + i % 3, i % 2) for i in range(12)]
    spark.createDataFrame(data, "id string, year int, month int, day int, hour int").write.partitionBy(
        "year", "month", "day", "hour"
    ).json(lake)
    df = files.read_json_lake(spark, lake, spark.createDataFrame([("1",)], "id string").schema, "day = 2 AND hour = 0")
    assert sorted(r["id"] for r in df.collect()) == ["10", "4"]
    assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().executedPlan().toString()


def test_parquet_sink(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(spark.range(3).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert spark.read.parquet(path).where("k = 1").count() == 1
    assert files.constant_rows(spark, [(1,), (None,)], "id int").count() == 2


@pytest.fixture()
def table_name(spark):
    name = f"t{dt.datetime.now().timestamp()}".replace(".", "_")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


SCHEMA = "id long, user_id long, timestamp timestamp_ntz"


def test_incremental_load_is_idempotent(spark, table_name):
    data = [(i, i % 3, dt.datetime(2024, 1, 1 + i // 4)) for i in range(12)]
    df = spark.createDataFrame(data, SCHEMA)
    assert tables.high_water_mark(spark, table_name) is None
    assert tables.load_increment(df.where("id < 8"), table_name, key=["id"]) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert tables.high_water_mark(spark, table_name) == dt.datetime(2024, 1, 2)
    assert tables.load_increment(df, table_name, key=["id"]) == [dt.date(2024, 1, 3)]
    assert tables.load_increment(df, table_name, key=["id"]) == []
    assert rows(spark.table(table_name).groupBy("day").count()) == [(dt.date(2024, 1, d), 4) for d in (1, 2, 3)]
    plan = spark.table(table_name).where("day = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


@pytest.mark.parametrize("key", [["id"], None])
def test_incremental_load_takes_equal_and_late_times_once(spark, table_name, key):
    first = [(1, 1, dt.datetime(2024, 1, 5, 12)), (2, 1, None)]
    # Equal times, late by a day, and late by years.
    later = first + [(3, 1, dt.datetime(2024, 1, 5, 12)), (4, 2, dt.datetime(2024, 1, 4)), (5, 2, dt.datetime(2019, 7, 1)), (6, None, None)]
    for data in (first, later, later[::-1]):
        tables.load_increment(spark.createDataFrame(data + data[:1], SCHEMA), table_name, key=key)
    assert sorted(r["id"] for r in spark.table(table_name).collect()) == [1, 2, 3, 4, 5, 6]


def test_incremental_load_rewrites_touched_days_alone(spark, table_name, tmp_path):
    path = str(tmp_path / "loaded")
    data = [(i, i, dt.datetime(2024, 1, 1 + i)) for i in range(5)]
    tables.load_increment(spark.createDataFrame(data, SCHEMA), table_name, key=["id"], path=path)
    before = {d.name: sorted(f.name for f in d.iterdir()) for d in (tmp_path / "loaded").glob("day=*")}
    changed = [(2, 77, dt.datetime(2024, 1, 3)), (9, 9, dt.datetime(2024, 1, 3)), (3, 3, dt.datetime(2024, 1, 4))]
    assert tables.load_increment(spark.createDataFrame(changed, SCHEMA), table_name, key=["id"]) == [dt.date(2024, 1, 3)]
    after = {d.name: sorted(f.name for f in d.iterdir()) for d in (tmp_path / "loaded").glob("day=*")}
    assert [d for d in before if before[d] != after[d]] == ["day=2024-01-03"]
    got = sorted((r["id"], r["user_id"]) for r in spark.table(table_name).collect())
    assert got == [(0, 0), (1, 1), (2, 77), (3, 3), (4, 4), (9, 9)]
    # Of several rows of a key the newest counts.
    twice = [(4, 50, dt.datetime(2024, 1, 5, 1)), (4, 51, dt.datetime(2024, 1, 5, 2))]
    tables.load_increment(spark.createDataFrame(twice, SCHEMA), table_name, key=["id"])
    assert spark.table(table_name).where("id = 4").first()["user_id"] == 51


def test_incremental_load_of_keys_that_move(spark, table_name):
    data = [(1, 1, dt.datetime(2024, 1, 1)), (2, 2, dt.datetime(2024, 1, 2)), (3, 3, dt.datetime(2024, 1, 2)), (4, 4, None)]
    tables.load_increment(spark.createDataFrame(data, SCHEMA), table_name, key=["id"])
    moved = [(1, 1, dt.datetime(2024, 1, 2)), (4, 4, dt.datetime(2024, 1, 9))]
    days = tables.load_increment(spark.createDataFrame(moved, SCHEMA), table_name, key=["id"], keys_move=True)
    assert set(days) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 9), None}
    got = sorted((r["id"], str(r["day"])) for r in spark.table(table_name).collect())
    assert got == [(1, "2024-01-02"), (2, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-09")]


def test_append_copy_and_buckets(spark, table_name):
    df = spark.range(10).withColumnRenamed("id", "user_id")
    tables.append(df, table_name)
    tables.append(df, table_name)
    tables.copy_table(spark, table_name, f"{table_name}_copy")
    assert spark.table(f"{table_name}_copy").count() == 20
    tables.append_bucketed(df, f"{table_name}_a", 4)
    tables.append_bucketed(df, f"{table_name}_b", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{table_name}_a").join(spark.table(f"{table_name}_b"), "user_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in ("copy", "a", "b"):
            spark.sql(f"DROP TABLE {table_name}_{n}")


def test_materialise(spark, table_name):
    df = spark.range(5)
    tables.materialise(df, "a_view")
    assert spark.table("a_view").count() == 5
    tables.materialise(df, table_name, "table", [F.desc("id")])
    tables.materialise(df.limit(2), table_name, "table")
    assert spark.table(table_name).count() == 2
    with pytest.raises(ValueError):
        tables.materialise(df, "x", "cube")


def test_relations_by_name(spark):
    for day in ("20180101", "20180102", "20180103"):
        spark.createDataFrame([(int(day[-1]), "play")], "user_id int, event string").write.mode("overwrite").saveAsTable(f"data_events_{day}")
    try:
        found = tables.relations_by_pattern(spark, "DEF%", "Data_Events_%")
        assert found == [f"default.data_events_2018010{d}" for d in (1, 2, 3)]
        assert tables.relations_by_prefix(spark, "default", "data_events_", "%02") == [found[0], found[2]]
        union = tables.union_tables(spark, found)
        same(union.drop("_dbt_source_relation"), [(1, "play"), (2, "play"), (3, "play")], "user_id event")
    finally:
        for day in ("20180101", "20180102", "20180103"):
            spark.sql(f"DROP TABLE data_events_{day}")


def test_exchange_rates(spark):
    data = [("USD", 1700000000, {"EUR": 0.9, "GBP": 0.8}), (None, 1, {"X": 1.0}), ("USD", None, {"X": 1.0}), ("USD", 1, None)]
    got = feeds.exchange_rates(spark.createDataFrame(data, S.RATE_SNAPSHOT), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    same(
        got.select("key", "rate", "api_timestamp_iso_utc", "fetch_timestamp_iso_utc"),
        [
            ("USD_EUR", 0.9, "2023-11-14T22:13:20+00:00", "2024-01-01T00:00:00.000000+00:00"),
            ("USD_GBP", 0.8, "2023-11-14T22:13:20+00:00", "2024-01-01T00:00:00.000000+00:00"),
        ],
    )


def test_indicator_feed(spark):
    data = [("GDP", "2024-01-01", "1.5"), ("GDP", "2024-04-01", "."), ("UNRATE", "2024-01-01", "4"), ("NOPE", "2024-01-01", "1")]
    obs = spark.createDataFrame(data, S.INDICATOR_OBSERVATION)
    latest = feeds.latest_observations(obs.select("series_id", "date", "value"))
    got = feeds.indicators(latest)
    assert got.columns == S.INDICATOR_MESSAGE.fieldNames()
    same(
        got.select("indicator_id", "indicator_name", "value", "frequency", "source"),
        [("GDP", "Gross Domestic Product", 0.0, "quarterly", "FRED"), ("UNRATE", "Unemployment Rate", 4.0, "monthly", "FRED")],
    )
    assert feeds.indicators(latest, missing_as_zero=False).where("value IS NULL").count() == 1


def test_messages(spark):
    df = spark.createDataFrame([("USD_EUR", "USD", 0.9)], "key string, base_currency string, rate double")
    got = feeds.to_messages(df, "key").first()
    assert got["key"] == "USD_EUR" and bytes(got["value"]).decode() == '{"base_currency":"USD","rate":0.9}'
    assert feeds.to_messages(df, feeds.DELIVERY_KEYS["exchange_rates"]).first()["key"] == "USD"


def test_latest_observation_does_not_depend_on_row_order(spark):
    data = [("a", "2024-01-02", "x"), ("a", "2024-01-02", "y"), ("a", "2024-01-01", "z"), ("b", None, "w")]
    got = [
        sorted(map(tuple, feeds.latest_observations(spark.createDataFrame(d, "series_id string, date string, value string")).collect()), key=repr)
        for d in (data, data[::-1])
    ]
    assert got[0] == got[1] and [r[0] for r in got[0]] == ["a", "b"] and got[0][1] == ("b", None, "w")
