"""Sliced frames against plain window SQL, with one key that holds a third of the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import bag, rows
from txnspark.operators.windows import adjacent_pairs, fit_slice_seconds, hot_keys, lag_by_slice, rolling_count, rolling_rows, stored_hot_keys

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module", params=[1])
def frame(spark, request):
    rng = random.Random(request.param)
    data = []
    for i in range(1500):
        key = None if rng.random() < 0.03 else ("hot" if rng.random() < 0.34 else f"k{rng.randrange(8)}")
        # Coarse seconds give equal instants; a long gap in the middle leaves slices empty.
        ts = T0 + dt.timedelta(seconds=rng.randrange(0, 4 * 86400, 450) + (0 if rng.random() < 0.5 else 20 * 86400))
        value = None if rng.random() < 0.05 else decimal.Decimal(rng.randrange(1, 10000)) / 100
        data.append((i, key, None if rng.random() < 0.01 else ts, value))
    return spark.createDataFrame(data, "id long, k string, ts timestamp_ntz, v decimal(12,2)").repartition(5), data


def _duck(duck, data, sql):
    t = pd.DataFrame(data, columns=["id", "k", "ts", "v"]).astype({"ts": "datetime64[us]"})
    duck.register("t0", t)
    duck.execute("create or replace temp table t as select id, k, ts, cast(v as decimal(12,2)) v from t0")
    return bag(duck.sql(sql).fetchall())


@pytest.mark.parametrize("slices", [1, 24, 4])
def test_rolling_count_matches_range_frame(frame, duck, slices):
    df, data = frame
    got = rows(rolling_count(df, ["k"], "ts", 86400, "c", slices).select("id", "c"))
    want = _duck(
        duck,
        data,
        """select id, count(*) over (partition by k order by ts nulls first
           range between interval 1 day preceding and current row) from t""",
    )
    assert got == want


def _hot(df, more_than):
    return None if more_than is None else hot_keys(df, ["k"], more_than)


# All keys cut, only the key with a third of the rows cut, no key hot enough, plain windows.
@pytest.mark.parametrize(("seconds", "more_than"), [(900, 0), (86400 * 3, 0), (3600, 300), (3600, 10_000), (900, None)])
def test_rolling_rows_matches_rows_frame(frame, duck, seconds, more_than):
    df, data = frame
    hot = _hot(df, more_than)
    rolled = rolling_rows(df, ["k"], ["ts", "id"], "v", {"c1": 1, "c3": 3}, {"a7": 7}, hot, seconds)
    got = rows(rolled.select("id", "c1", "c3", "a7"))
    want = _duck(
        duck,
        data,
        """select id, count(*) over (w rows between 1 preceding and current row),
                  count(*) over (w rows between 3 preceding and current row),
                  cast(sum(v) over (w rows between 7 preceding and current row) as double)
                  / nullif(count(v) over (w rows between 7 preceding and current row), 0)
           from t window w as (partition by k order by ts nulls first, id)""",
    )
    assert got == want


def test_sliced_averages_of_doubles_equal_plain_ones(spark, frame):
    df = frame[0].withColumn("v", F.col("v").cast("double") / 3)
    args = (["k"], ["ts", "id"], "v", {}, {"a7": 7})
    plain = rolling_rows(df, *args).select("id", "a7")
    sliced = rolling_rows(df, *args, hot_keys(df, ["k"], 0), 900).select("id", "a7")
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, plain.collect()))


def test_no_job_runs_while_frames_are_built(spark, frame):
    df = frame[0]
    spark.sparkContext.setJobGroup("frames", "frames")
    try:
        rolling_rows(df, ["k"], ["ts", "id"], "v", {"c": 1}, {"a": 7}, hot_keys(df, ["k"], 0))
        lag_by_slice(df, ["k"], ["ts", "id"], "v", "p", hot_keys(df, ["k"], 0))
        rolling_count(df, ["k"], "ts", 86400, "c")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("frames")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(("seconds", "more_than"), [(900, 0), (86400, 300), (86400, 10_000), (900, None)])
def test_lag_matches_plain_lag(frame, duck, seconds, more_than):
    df, data = frame
    got = rows(lag_by_slice(df, ["k"], ["ts", "id"], "v", "p", _hot(df, more_than), seconds).select("id", "p"))
    assert got == _duck(
        duck, data, "select id, lag(v) over (partition by k order by ts nulls first, id) from t"
    )


@pytest.mark.parametrize("partitions", ["1", "7", "200"])
def test_adjacent_pairs_cross_partition_edges(spark, frame, duck, partitions):
    df, data = frame
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = adjacent_pairs(df.select("k", "ts", "id"), ["k", "ts", "id"], lambda n: n.isNotNull())
        got = rows(pairs.select("id", "_next.id"))
        few = adjacent_pairs(df.select("k", "ts", "id"), ["k", "ts", "id"], lambda n: n["id"] % 50 == 0)
        got_few = rows(few.select("id", "_next.id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    base = "select id, lead(id) over (order by k nulls first, ts nulls first, id) n from t"
    assert got == _duck(duck, data, f"select * from ({base}) where n is not null")
    assert got_few == _duck(duck, data, f"select * from ({base}) where n % 50 = 0")


def test_slice_width_fits_the_hottest_key(frame):
    df, data = frame
    width = fit_slice_seconds(df, ["k"], "ts", target_rows=20, start_seconds=86400)
    slices = Counter(int((r[2] - T0).total_seconds()) // width for r in data if r[1] == "hot" and r[2])
    hottest = max(slices.values())
    assert 1 <= width < 86400 and hottest <= 20
    assert fit_slice_seconds(df, ["k"], "ts") == 3600


def test_adjacent_pairs_move_the_rows_once(spark, frame):
    """One exchange of rows; what else crosses the network has been aggregated to a row per bucket."""
    import re

    df, _ = frame
    plan = adjacent_pairs(df.select("k", "ts", "id"), ["k", "ts", "id"], lambda n: n.isNotNull())._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if line.strip()]
    wide = [
        i for i, line in enumerate(lines)
        if re.search(r"(?<!Broadcast)Exchange (hash|range|Single)", line) and not re.search("partial_|Window|Aggregate", " ".join(lines[i + 1 : i + 3]))
    ]
    assert len(wide) == 1, plan


def test_adjacent_pairs_of_copies(spark):
    """A value that fills buckets by itself is counted, and its copies still follow each other."""
    data = [(5,)] * 900 + [(i,) for i in range(40)] + [(None,)] * 300
    df = spark.createDataFrame(data, "v int").repartition(7)
    pairs = adjacent_pairs(df, ["v"], lambda n: n.isNotNull())
    got = Counter((r["v"], r["_next"]["v"]) for r in pairs.collect())
    order = sorted((v for (v,) in data), key=lambda v: (v is not None, v or 0))
    assert got == Counter(zip(order, order[1:], strict=False))


def test_stored_hot_keys_are_read_and_not_counted_again(frame):
    df, _ = frame
    hot = stored_hot_keys(df, ["k"], 100)
    assert rows(hot) == rows(hot_keys(df, ["k"], 100))
    sliced = rolling_rows(df, ["k"], ["ts", "id"], "v", {"c1": 1}, {"a7": 7}, hot, 900)
    plain = rolling_rows(df, ["k"], ["ts", "id"], "v", {"c1": 1}, {"a7": 7})
    assert rows(sliced.select("id", "c1", "a7")) == rows(plain.select("id", "c1", "a7"))
    assert "hot-keys-" in sliced._jdf.queryExecution().executedPlan().toString()
