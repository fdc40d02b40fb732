"""Golden values of the scalar helpers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, same
from txnspark import functions as X


def test_surrogate_key(spark):
    data = [
        ("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        (None, None, None, "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]
    df = spark.createDataFrame(data, "a string, b string, c string, one string, all string")
    wrong = df.where((X.surrogate_key("a") != F.col("one")) | (X.surrogate_key("a", "b", "c") != F.col("all")))
    assert wrong.count() == 0


def test_safe_add(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(X.safe_add("a", "b", "c")).collect()] == [6, 4, 2, 0]


def test_safe_divide(spark):
    data = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(data, "n int, d int")
    assert [r[0] for r in df.select(X.safe_divide("n", "d")).collect()] == [None, 2, None, None, None, None, None, 0]
    products = spark.createDataFrame([(0, 5, 9, 0.0), (2, 3, 0, None), (2, 5, 2, 5.0)], "a int, b int, d int, o double")
    got = products.select(X.safe_divide(F.col("a") * F.col("b"), "d"), "o").collect()
    assert all(a == b for a, b in got)


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a, 4, 200000.0, 600000.0) for a in amounts], "v double, n int, lo double, hi double")
    assert [r[0] for r in df.select(X.width_bucket("v", "lo", "hi", F.col("n"))).collect()] == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(spark):
    df = spark.createDataFrame(
        [(48.864716, 2.349014, 52.379189, 4.899431), (None, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 180.0)],
        "a double, b double, c double, d double",
    )
    got = df.select(
        F.round(X.haversine_distance("a", "b", "c", "d")),
        F.round(X.haversine_distance("a", "b", "c", "d", "km")),
        F.round(X.point_distance_m("a", "b", "c", "d") / 1000),
    ).collect()
    assert tuple(got[0]) == (267, 430, 430)
    assert tuple(got[1]) == (None, None, None)
    assert got[2][2] == 20015
    with pytest.raises(ValueError):
        X.haversine_distance("a", "b", "c", "d", "yd")


URLS = [
    ("www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer", "www.google.co.uk", ""),
    (
        "http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/",
        "witanddelight.com",
        "2018/01/tips-tricks-how-run-half-marathon-first-time/",
    ),
    ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog"),
    ("https://m.facebook.com/", "m.facebook.com", ""),
    ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com", "2021/01/01/index.js"),
    ("plain.example", "plain.example", "plain.example"),
]


def test_url_host_and_path(spark):
    df = spark.createDataFrame(URLS, "url string, host string, path string")
    assert df.where((X.url_host("url") != F.col("host")) | (X.url_path("url") != F.col("path"))).count() == 0
    assert spark.range(1).select(X.url_host(F.lit("android-app://m.facebook.com/"))).first()[0] == "m.facebook.com"


def test_url_parameter(spark):
    data = [
        ("http://drewbanin.com/milky?utm_medium=organic", "organic", None),
        ("http://drewbanin.com/milky?utm_medium=organic&utm_source=github", "organic", "github"),
        ("http://x/?p=&q=1", None, None),
    ]
    df = spark.createDataFrame(data, "url string, medium string, source string")
    got = df.select(X.url_parameter("url", "utm_medium"), X.url_parameter("url", "utm_source")).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in data]
    assert spark.range(1).select(X.url_parameter(F.lit("a?xp=7"), "p")).first()[0] == "7"


def test_slugify():
    assert X.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert X.slugify("0Hell0 world-hi") == "_0hell0_world_hi"


def test_json_scalar(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"d":1},"c":[1],"e":"x"}',), ("not json",)], "j string")
    got = df.select(*[X.json_scalar("j", f"$.{k}") for k in "abce"]).collect()
    assert tuple(got[0]) == ("1", None, None, "x")
    assert tuple(got[1]) == (None,) * 4
    odd = spark.createDataFrame([('{"a":"[Acme] Shop","b":"{x}","c":" [","d":{"e":1},"f":"[1]"}',)], "j string")
    got = odd.select(*[X.json_scalar("j", f"$.{k}") for k in "abcdf"]).first()
    assert tuple(got) == ("[Acme] Shop", "{x}", " [", None, "[1]")


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31), dt.datetime(2024, 3, 15))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(
        X.months_between_whole("a", "b"),
        X.intervals_between("month", "a", "b"),
        X.intervals_between("day", "a", "b"),
        X.add_interval("day", -1, "a"),
        X.local_wall_clock(F.lit("2024-06-01 00:00:00").cast("timestamp"), "Africa/Cairo"),
        X.iso_utc(F.lit(1700000000)),
    ).first()
    assert tuple(got)[:3] == (1, 2, 44)
    assert got[3] == dt.datetime(2024, 1, 30)
    assert got[4] == dt.datetime(2024, 6, 1, 3)
    assert got[5] == "2023-11-14T22:13:20+00:00"
    with pytest.raises(ValueError):
        X.add_interval("fortnight", 1, "a")


def test_no_python_udf_in_plans(spark):
    df = spark.createDataFrame([("http://a/b?c=1",)], "u string")
    plan = df.select(X.url_host("u"), X.url_path("u"), X.surrogate_key("u"))._jdf.queryExecution().toString()
    assert "Python" not in plan
    same(df.select(X.url_host("u").alias("h")), [("a",)])
    assert rows(df.select(X.url_path("u"))) == [("b",)]
