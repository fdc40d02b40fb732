"""Ordered-frame operators that stay balanced when one key holds a large share of the rows.

``Window.partitionBy(key)`` sorts a whole key in one task. The operators below cut keys into time slices, work per
(key, slice) and carry a small, bounded state from slice to slice:

* ``with_carry`` cuts the keys the caller names as hot and brings the last k earlier rows to each of their slices (lag
  and ROWS frames); without such keys lag and ROWS frames are plain windows;
* ``rolling_count`` adds up an interval frame from per-slice totals plus arrivals and expiries inside a slice;
* ``adjacent_pairs`` compares neighbours of a global order through buckets between sampled bounds and their edges.

A slice must fit one task (it spills to disk): ``fit_slice_seconds`` finds the width at which the hottest one does.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.session import scratch_path

HOUR = 3600
DAY = 24 * HOUR


def micros(ts: Column | str) -> Column:
    """Position on the time axis in microseconds (dates and zone-less timestamps included)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def time_slice(ts: Column | str, seconds: int = HOUR) -> Column:
    """Number of the time slice a timestamp falls into."""
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def fit_slice_seconds(
    df: DataFrame, keys: Sequence[str], ts: str, target_rows: int = 5_000_000, start_seconds: int = HOUR
) -> int:
    """Slice width at which no (key, slice) holds more than ``target_rows``, found by counting.

    One aggregate per step; the width shrinks by the measured excess until the hottest slice fits or is one second.
    """
    seconds = start_seconds
    while True:
        counted = df.groupBy(*keys, time_slice(ts, seconds).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
        hottest = counted.agg(F.max("_n")).first()[0] or 0
        if hottest <= target_rows or seconds == 1:
            return seconds
        seconds = max(1, seconds // -(-hottest // target_rows))


def hot_keys(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """Keys with more than ``more_than`` rows: at most rows / ``more_than`` of them, for the ``hot`` argument below. Lazy;
    a stored result spares the count and lets Spark see that it is small."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than).select(*keys)


def stored_hot_keys(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """``hot_keys``, counted once and stored next to the checkpoints: frames that use it several times do not count again,
    and Spark sees how small it is."""
    path = scratch_path(df.sparkSession, "hot-keys")
    hot = hot_keys(df, keys, more_than)
    hot.write.parquet(path)
    return df.sparkSession.read.schema(hot.schema).parquet(path)


def with_carry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    rows: int,
    hot: DataFrame,
    slice_seconds: int = HOUR,
    source: DataFrame | None = None,
) -> tuple[DataFrame, WindowSpec]:
    """Rows with the state of the earlier slices, and the window that orders a slice.

    Keys in ``hot`` (distinct rows of ``keys``) are cut by time, any other key is one slice. A slice of a hot key starts
    with a header row (``_kind`` 0) whose ``_carry`` holds structs of ``values`` for at most ``rows`` rows that precede
    the slice, oldest first. The rows get ``_carry`` from their header and ``_rn``, their number inside the slice.
    Headers ride along in the shuffle the window needs anyway; callers drop them at the end with ``without_headers``.
    ``order[0]`` must be the time column; further columns break ties. The state is computed from ``source``: a frame
    with the same rows that is cheaper to produce than ``df`` (without its joins, say).
    """
    base = df if source is None else source
    none = F.array().cast(T.ArrayType(T.StructType([df.schema[v] for v in values])))
    hot = hot.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(keys)], F.lit(True).alias("_hot"))

    def mark(frame: DataFrame, how: str) -> DataFrame:
        same = F.lit(True)
        for i, c in enumerate(keys):
            same = same & frame[c].eqNullSafe(hot[f"_h{i}"])
        marked = frame.join(hot, same, how).withColumn("_slice", F.when(F.col("_hot"), time_slice(order[0], slice_seconds)))
        return marked.drop("_hot", *[f"_h{i}" for i in range(len(keys))])

    group = [*keys, "_slice"]
    newest_first = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        mark(base.select(*dict.fromkeys([*keys, *order, *values])), "inner")
        # Filtering a row number lets Spark keep only `rows` per group before the shuffle.
        .withColumn("_back", F.row_number().over(newest_first))
        .where(F.col("_back") <= rows)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_p"), F.struct(*values).alias("v")))).alias("_t"))
        .withColumn("_t", F.transform("_t", lambda x: x["v"]))
    )
    # One row per slice of a hot key, so this window is bounded by the time span of the data.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(-rows, -1)
    found = tails.withColumn("_all", F.flatten(F.collect_list("_t").over(earlier)))
    newest = F.when(F.size("_all") <= rows, F.col("_all")).otherwise(
        F.slice("_all", F.greatest(F.size("_all") - rows + 1, F.lit(1)), F.lit(rows))
    )
    headers = found.select(*group, newest.alias("_header"), F.lit(0).alias("_kind"))
    in_order = Window.partitionBy(*group).orderBy("_kind", *order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    both = mark(df, "left").withColumn("_kind", F.lit(1)).unionByName(headers, allowMissingColumns=True)
    carry = F.coalesce(F.first("_header").over(so_far), none)
    carried = both.withColumns({"_carry": carry, "_rn": F.sum("_kind").over(so_far)})
    return carried.drop("_header"), in_order


def without_headers(df: DataFrame) -> DataFrame:
    return df.where(F.col("_kind") == 1).drop("_slice", "_kind", "_rn", "_carry")


def lag_by_slice(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    hot: DataFrame | None = None,
    slice_seconds: int = 30 * DAY,
) -> DataFrame:
    """WIN-04: previous value of a column per key, in the given order; keys in ``hot`` are worked on in time slices."""
    if hot is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    carried, in_order = with_carry(df, keys, order, [value], 1, hot, slice_seconds)
    before = F.try_element_at("_carry", F.lit(-1))[value]
    previous = F.when(F.col("_rn") > 1, F.lag(value).over(in_order)).otherwise(before)
    return without_headers(carried.withColumn(out, previous))


def rolling_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    counts: dict[str, int],
    averages: dict[str, int],
    hot: DataFrame | None = None,
    slice_seconds: int = HOUR,
    source: DataFrame | None = None,
) -> DataFrame:
    """WIN-01, WIN-02: COUNT(*) and AVG(value) over ``ROWS n PRECEDING .. CURRENT ROW``.

    ``counts`` and ``averages`` map an output column to its n. Keys in ``hot`` are worked on in time slices, with the
    same results to the last bit: a frame's values are added oldest first either way.
    """
    if hot is None:
        in_order = Window.partitionBy(*keys).orderBy(*order)
        result = df
        for out, n in counts.items():
            result = result.withColumn(out, F.count(F.lit(1)).over(in_order.rowsBetween(-n, 0)))
        for out, n in averages.items():
            frame = in_order.rowsBetween(-n, 0)
            total, known = F.sum(value).over(frame), F.count(value).over(frame)
            result = result.withColumn(out, F.try_divide(total.cast("double"), known.cast("double")))
        return result

    rows = max([*counts.values(), *averages.values()])
    result, in_order = with_carry(df, keys, order, [value], rows, hot, slice_seconds, source)
    kind = df.schema[value].dataType
    for out, n in counts.items():
        result = result.withColumn(out, F.least(F.col("_rn") + F.size("_carry"), F.lit(n + 1)).cast("bigint"))
    for out, n in averages.items():
        # A header inside the frame has no value and does not count.
        own = F.collect_list(value).over(in_order.rowsBetween(-n, 0))
        missing = F.greatest(F.lit(n + 1) - F.col("_rn"), F.lit(0))
        before = F.slice("_carry", F.greatest(F.size("_carry") - missing + 1, F.lit(1)), missing)
        before = F.filter(F.transform(before, lambda x: x[value]), lambda x: x.isNotNull())
        result = result.withColumn(out, F.concat(before, own))
        total = F.aggregate(out, F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind))
        result = result.withColumn(out, F.try_divide(total.cast("double"), F.size(out).cast("double")))
    return without_headers(result)


def rolling_count(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    span_seconds: int,
    out: str,
    slices_per_span: int = 24,
    source: DataFrame | None = None,
) -> DataFrame:
    """WIN-03: COUNT(*) over ``RANGE span PRECEDING .. CURRENT ROW`` per key; rows of one instant are peers.

    Rows are first counted per (key, instant). Inside a slice the frame is a running sum of arrivals and of
    expiries (arrivals of the slice one span earlier), on top of the totals of the slices in between. The counts come
    from ``source``, a frame with the same rows that is cheaper to produce than ``df``.
    """
    span = span_seconds * 1_000_000
    if span % slices_per_span:
        raise ValueError("span must be a whole number of slices")
    width = span // slices_per_span

    instants = (
        (df if source is None else source)
        .groupBy(*keys, ts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_at", micros(ts))
        .withColumn("_slice", F.floor(F.col("_at") / F.lit(width)).cast("bigint"))
    )

    def step(at: Column, slice_: Column, kind: int, delta: Column) -> Column:
        return F.struct(
            at.alias("_at"), slice_.alias("_slice"), F.lit(kind).alias("_kind"), delta.cast("bigint").alias("_delta")
        )

    arrive = step(F.col("_at"), F.col("_slice"), 1, F.col("_n"))
    expire = step(F.col("_at") + F.lit(span), F.col("_slice") + F.lit(slices_per_span), 2, -F.col("_n"))
    steps = instants.select(
        *keys,
        ts,
        F.inline(F.when(F.col("_at").isNull(), F.array(arrive)).otherwise(F.array(arrive, expire))),
    )
    totals = instants.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(-slices_per_span, -1)
    openings = totals.where(F.col("_slice").isNotNull()).select(
        *keys,
        F.lit(None).cast(instants.schema[ts].dataType).alias(ts),
        (F.col("_slice") * F.lit(width)).alias("_at"),
        "_slice",
        F.lit(0).alias("_kind"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("bigint").alias("_delta"),
    )
    # Kinds order steps of one instant: opening balance, arrivals, expiries.
    running = Window.partitionBy(*keys, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    frames = (
        openings.unionByName(steps)
        .withColumn(out, F.sum("_delta").over(running))
        .where(F.col("_kind") == 1)
        .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, ts])], out)
    )
    condition = F.lit(True)
    for i, c in enumerate([*keys, ts]):
        condition = condition & df[c].eqNullSafe(frames[f"_k{i}"])
    return df.join(frames, condition, "left").drop(*[f"_k{i}" for i in range(len(keys) + 1)])


SAMPLES_PER_BUCKET = 20


def repeat(df: DataFrame, times: str) -> DataFrame:
    """Write every row ``times`` times, in blocks so that no array is longer than 10 000."""
    block = F.lit(10_000)
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / block))))
    size = F.least(F.col(times) - F.col("_block") * block, block)
    return blocks.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), size.cast("bigint")))).drop("_block", "_i")


def sampled_bounds(df: DataFrame, order: Sequence[str], buckets: int) -> tuple[Column, Column | None]:
    """(quantiles of the rows in their order, rows that are more than a bucket by themselves) as literal arrays, from about
    ``SAMPLES_PER_BUCKET`` rows a bucket."""
    rows, wanted = df.select(*order), SAMPLES_PER_BUCKET * buckets
    fraction = min(1.0, wanted / max(rows.count(), 1))
    sample = [tuple(r) for r in rows.sample(fraction, 7).orderBy(*order).collect()]
    kinds = [df.schema[c].dataType for c in order]

    def literal(row: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, kinds, order, strict=True)])

    often = [row for row, n in Counter(sample).items() if n >= SAMPLES_PER_BUCKET]
    step = max(1, len(sample) // buckets)
    bounds = list(dict.fromkeys(sample[step::step]))
    return F.array(*map(literal, bounds)), F.array(*map(literal, often)) if often else None


def bucket_of(row: Column, bounds: Column, buckets: int) -> Column:
    """Number of sorted bounds that are not after the row, by binary search."""

    def halve(range_: Column, _: Column) -> Column:
        middle = F.floor((range_["lo"] + range_["hi"]) / 2).cast("int")
        after = (range_["lo"] < range_["hi"]) & (F.get(bounds, middle) <= row)
        stays = range_["lo"] >= range_["hi"]
        return F.struct(
            F.when(after, middle + 1).otherwise(range_["lo"]).alias("lo"),
            F.when(after | stays, range_["hi"]).otherwise(middle).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(buckets.bit_length())), start, halve, lambda found: found["lo"])


def adjacent_pairs(
    df: DataFrame,
    order: Sequence[str],
    keep: Callable[[Column], Column],
) -> DataFrame:
    """Rows of a globally ordered frame that ``keep`` selects, with their successor as struct ``_next``.

    ``keep`` receives the successor (NULL for the very last row). No key is needed, and one exchange moves the rows: a
    sample gives the bounds of buckets, a window compares the neighbours inside a bucket, and the first row of each
    bucket, one row per bucket and task, is the successor of the last row before. Rows that fill a bucket with copies of
    themselves are counted instead of moved. Further columns order equal rows.
    """
    columns = df.columns
    full = [*order, *[c for c in columns if c not in order]]
    buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, often = sampled_bounds(df, full, buckets)
    cur, row = F.struct(*columns), F.struct(*full)
    rows, copied = df, None
    if often is not None:
        hot = F.array_contains(often, row)
        copied = df.where(hot).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        rows = df.where(~hot).unionByName(copied.drop("_n"))
    placed = rows.withColumn("_bucket", bucket_of(row, bounds, buckets))
    w = Window.partitionBy("_bucket").orderBy(*full)
    local = placed.withColumn("_next", F.lead(cur).over(w))
    heads = placed.groupBy("_bucket").agg(F.min(row).alias("_least"))
    least = F.struct(*[F.col("_least")[c].alias(c) for c in columns])
    heads = heads.select(F.col("_bucket").alias("_at"), F.lead(least).over(Window.orderBy("_bucket")).alias("_ahead"))
    joined = local.join(F.broadcast(heads), F.col("_bucket") == F.col("_at"), "left")
    joined = joined.withColumn("_next", F.coalesce("_next", "_ahead")).select(*columns, "_next")
    pairs = joined.where(F.coalesce(keep(F.col("_next")), F.lit(False)))
    if copied is None:
        return pairs
    # All but the last copy are followed by an equal row.
    again = copied.where("_n > 1").withColumn("_n", F.col("_n") - 1).withColumn("_next", cur)
    again = again.where(F.coalesce(keep(F.col("_next")), F.lit(False)))
    return pairs.unionByName(repeat(again, "_n").drop("_n"))


def previous_day_change(daily: DataFrame, day: str, value: str, out: str) -> DataFrame:
    """WIN-05: day-on-day change in percent over an already aggregated frame (one row per day)."""
    before = F.lag(value).over(Window.orderBy(day))
    return daily.withColumn(out, F.round(F.try_divide((F.col(value) - before) * 100.0, before), 2))
