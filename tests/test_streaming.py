"""Streams from files: same rows as batch, exactly once across a restart."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from txnspark import schemas as S
from txnspark.operators import contracts as C
from txnspark.streaming import ingest

TOPIC = "value binary, arrived timestamp"


def write_topic(spark, path, texts, mode="append"):
    data = [(t.encode() if t is not None else None, dt.datetime(2024, 1, 1, i % 3)) for i, t in enumerate(texts)]
    spark.createDataFrame(data, TOPIC).coalesce(1).write.mode(mode).parquet(path)


def topic(spark, path):
    return ingest.read_files(spark, path, spark.createDataFrame([], TOPIC).schema, max_files_per_trigger=1)


def body(i, **more):
    return json.dumps({"transaction_id": f"t{i}", "user_id": i, "amount": 1.0 + i, "timestamp": "2024-01-01T00:00:00Z"} | more)


def test_lake_restart_is_exactly_once(spark, tmp_path):
    source, lake, ckpt = (str(tmp_path / n) for n in ("topic", "lake", "ckpt"))
    write_topic(spark, source, [body(i) for i in range(20)])

    def run():
        decoded = ingest.decode_json(topic(spark, source))
        good, _ = ingest.split_corrupt(decoded)
        stamped = ingest.stamp_received(good, F.lit("2024-01-01 07:30:00").cast("timestamp"))
        ingest.write_lake(ingest.with_arrival_parts(stamped), lake, ckpt, once=True).awaitTermination()

    run()
    write_topic(spark, source, [body(i) for i in range(20, 30)])
    run()
    run()
    back = spark.read.parquet(lake)
    assert back.count() == 30 and back.select("transaction_id").distinct().count() == 30
    assert (tmp_path / "lake" / "year=2024" / "month=01" / "day=01" / "hour=07").is_dir()


def test_received_at_is_kept(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), (None,)], "received_at string")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert rows(ingest.stamp_received(df, now)) == [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 2, 1),)]
    assert ingest.stamp_received(spark.range(1), now).columns == ["id", "received_at"]
    parts = ingest.with_arrival_parts(ingest.stamp_received(df, now), parts=ingest.INDICATOR_PARTITIONS)
    assert parts.columns[-3:] == ["year", "month", "day"]


def test_rejects(spark, tmp_path):
    source = str(tmp_path / "topic")
    write_topic(spark, source, [body(1), "{broken", None, body(2, amount=0.0), body(3, currency="usd")])
    decoded = ingest.decode_json(topic(spark, source))
    rules = [
        C.Rule("payload: json", F.col("_corrupt").isNull()),
        *C.required("transaction_id"),
        C.minimum("amount", 0.01),
        C.pattern("currency", S.CURRENCY_PATTERN),
    ]
    target, ckpt = (str(tmp_path / n) for n in ("target", "ckpt"))
    ingest.write_with_rejects(decoded, rules, target, ckpt, once=True).awaitTermination()
    assert [r["transaction_id"] for r in ingest.committed(spark, target, decoded.schema).collect()] == ["t1"]
    reasons = sorted(tuple(r["violations"]) for r in ingest.committed(spark, target, decoded.schema, rejected=True).collect())
    assert reasons == [("amount: minimum",), ("currency: pattern",), ("payload: json", "transaction_id: required")]


def _accept(spark, source, target, ckpt):
    decoded = ingest.decode_json(topic(spark, source))
    ingest.write_with_rejects(decoded, C.required("transaction_id"), target, ckpt, once=True).awaitTermination()
    return sorted(r["transaction_id"] for r in ingest.committed(spark, target, decoded.schema).collect())


def test_sinks_are_shared_and_restarted_without_loss(spark, tmp_path):
    target, one, two = (str(tmp_path / n) for n in ("target", "topic1", "topic2"))
    write_topic(spark, one, [body(1)])
    write_topic(spark, two, [body(2)])
    assert _accept(spark, one, target, str(tmp_path / "ckpt1")) == ["t1"]
    assert _accept(spark, two, target, str(tmp_path / "ckpt2")) == ["t1", "t2"]
    # A checkpoint lost and begun again at the same path starts at batch 0 with other messages.
    (tmp_path / "ckpt1").rename(tmp_path / "lost")
    three = str(tmp_path / "topic3")
    write_topic(spark, three, [body(3)])
    assert _accept(spark, three, target, str(tmp_path / "ckpt1")) == ["t1", "t2", "t3"]


def test_half_a_batch_is_never_seen(spark, tmp_path, monkeypatch):
    source, target, ckpt = (str(tmp_path / n) for n in ("topic", "target", "ckpt"))
    write_topic(spark, source, [body(1), body(2)])
    create = type(spark).createDataFrame

    def fail(self, *args, **kw):
        raise OSError("the manifest cannot be written")

    monkeypatch.setattr(type(spark), "createDataFrame", fail)
    decoded = ingest.decode_json(ingest.read_files(spark, source, T.StructType().add("value", "binary").add("arrived", "timestamp")))
    with pytest.raises(Exception):
        ingest.write_with_rejects(decoded, C.required("transaction_id"), target, ckpt, once=True).awaitTermination()
    monkeypatch.setattr(type(spark), "createDataFrame", create)
    # The rows were written, but no manifest names them; the batch runs again and is committed once.
    assert any((tmp_path / "target" / "data").iterdir())
    assert _accept(spark, source, target, ckpt) == ["t1", "t2"]
    assert _accept(spark, source, target, ckpt) == ["t1", "t2"]


def test_batches_hold_as_many_messages_as_asked(spark, tmp_path):
    source, target, ckpt = (str(tmp_path / n) for n in ("topic", "target", "ckpt"))
    ingest.land(spark.range(35).selectExpr("id"), source, rows_per_file=5)
    stream = ingest.read_bounded(spark, source, T.StructType().add("id", "long"), rows=10, rows_per_file=5)
    query = ingest.write_with_rejects(stream, C.required("id"), target, ckpt, once=True)
    query.awaitTermination()
    assert 0 < ingest.batch_rows(query) <= 10
    sizes = [r["accepted"] for r in ingest.manifests(spark, target).collect()]
    assert sum(sizes) == 35 and max(sizes) <= 10
    with pytest.raises(ValueError):
        ingest.read_bounded(spark, source, stream.schema, rows=4, rows_per_file=5)


def test_one_micro_batch_makes_many_flushes(spark, tmp_path):
    source, target, ckpt = (str(tmp_path / n) for n in ("topic", "target", "ckpt"))
    messages = spark.range(95).selectExpr("CASE WHEN id % 10 <> 0 THEN id END AS id", "id AS n")
    ingest.land(messages, source, rows_per_file=5)
    stream = ingest.read_bounded(spark, source, messages.schema, rows=5, rows_per_file=5, flushes=100)
    query = ingest.write_with_rejects(stream, C.required("id"), target, ckpt, once=True, flush_rows=5)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 1 and ingest.batch_rows(query) == 95
    flushes = ingest.manifests(spark, target).collect()
    assert max(f["accepted"] + f["rejected"] for f in flushes) <= 5 and len({f["folder"] for f in flushes}) == 1
    assert sum(f["accepted"] for f in flushes) == 85 and sum(f["rejected"] for f in flushes) == 10
    for rejected in (False, True):
        kept = ingest.committed(spark, target, messages.schema, rejected).collect()
        assert sorted(r["n"] for r in kept) == [i for i in range(95) if (i % 10 == 0) == rejected]


def test_deduplication_within_watermark(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("topic", "out", "ckpt"))
    write_topic(spark, source, [body(i % 10) for i in range(30)])
    write_topic(spark, source, [body(i % 12) for i in range(30)])
    keyed = ingest.event_time(ingest.decode_json(topic(spark, source)), "timestamp")
    once = ingest.deduplicate_stream(keyed, ["transaction_id"])
    ingest.lake_writer(once, out, ckpt, parts=(), once=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 12


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 3),)], "ts timestamp")
    assert ingest.fresh_only(df, "ts", 24, F.lit("2024-01-03 12:00:00")).count() == 1


def test_topic_to_table_skips_tombstones(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("topic", "out", "ckpt"))
    write_topic(spark, source, [body(1), None, body(2)])
    ingest.topic_to_table(topic(spark, source), ingest.decode_json, out, ckpt, once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_compaction(spark, tmp_path):
    lake, out = str(tmp_path / "lake"), str(tmp_path / "out")
    df = spark.range(40).selectExpr("id", "'2024' AS year", "'01' AS month", "'01' AS day", "cast(id % 2 AS string) AS hour")
    df.repartition(10).write.partitionBy("year", "month", "day", "hour").parquet(lake)
    ingest.compact(spark, lake, "hour = 1", out)
    assert spark.read.parquet(out).count() == 20


def test_kafka_options():
    plain = ingest.kafka_options("b:9092", "transactions", max_offsets_per_trigger=ingest.TRANSACTION_BATCH)
    assert plain["startingOffsets"] == "earliest" and plain["maxOffsetsPerTrigger"] == "100"
    assert "kafka.security.protocol" not in plain
    secure = ingest.kafka_options("b:9092", "transactions", "u", "p", group_prefix="g")
    assert secure["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in secure["kafka.sasl.jaas.config"]


def test_writer_triggers(spark, tmp_path):
    source = str(tmp_path / "topic")
    write_topic(spark, source, [body(1)])
    with pytest.raises(Exception):
        # Streams cannot be collected; the writer is the only way out.
        ingest.decode_json(topic(spark, source)).collect()
    assert ingest.lake_writer(topic(spark, source), str(tmp_path / "o"), str(tmp_path / "c"), parts=()) is not None


def test_table_streams_from_a_file_and_from_part_files(spark, tmp_path):
    from txnspark.catalog import registered

    source = "/root/testdata/sf0.001"
    for name in ("events", "orders"):
        spark.read.parquet(f"{source}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in ("str_05_partitioned_lake", "str_10_11_topic_to_table"):
        one, parts = (registered()[query](spark, where) for where in (source, str(tmp_path)))
        assert one.count() > 0 and one.exceptAll(parts).count() == 0 and parts.exceptAll(one).count() == 0
