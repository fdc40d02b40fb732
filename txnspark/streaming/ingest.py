"""Message streams to a partitioned lake (STR-01 .. STR-11).

The offsets of a query live in its checkpoint, so the file sink is exactly-once. The reference commits offsets while
rows may still sit in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txnspark import schemas as S
from txnspark.operators.contracts import Rule, validate

# Batch sizes and interval of the two consumers.
TRANSACTION_BATCH = 100
INDICATOR_BATCH = 10
# Flushes that one micro-batch admits: they are written by many tasks at once, so the driver's work per micro-batch is shared.
FLUSHES_PER_TRIGGER = 1000
FLUSH_SECONDS = 60
# Partition columns of the two lakes, by arrival time.
TRANSACTION_PARTITIONS = ("year", "month", "day", "hour")
INDICATOR_PARTITIONS = ("year", "month", "day")
# Registry framing: one magic byte and a four-byte schema id precede the Avro payload.
REGISTRY_HEADER_BYTES = 5


def kafka_options(
    servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    group_prefix: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """STR-01: options of a Kafka source that starts at the earliest offset; SASL_SSL when credentials are given."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if username and password:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
        }
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """STR-01: key and value columns of a topic. Needs Spark's Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load().select("key", "value", "timestamp")


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """STR-01 offline: a folder of files as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """STR-01 offline: one table of a folder as a stream, be it a single file or a folder of part files."""
    first = spark.read.schema(schema).parquet(f"{folder}/{name}").select(F.input_file_name().alias("file")).first()
    if first and first["file"].rstrip("/").endswith(f"/{name}"):
        return read_files(spark, folder, schema, name_filter=name)
    return read_files(spark, f"{folder}/{name}", schema)


def land(df: DataFrame, path: str, rows_per_file: int = TRANSACTION_BATCH) -> None:
    """STR-04 offline: a topic as files of at most ``rows_per_file`` messages, so that files admitted are messages admitted.
    All tasks write, however few files the rows come from."""
    spread = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    spread.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_bounded(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rows: int = TRANSACTION_BATCH,
    rows_per_file: int = TRANSACTION_BATCH,
    flushes: int = 1,
) -> DataFrame:
    """STR-04, STR-11 offline: micro-batches of at most ``rows`` messages from files of at most ``rows_per_file``.

    With ``flushes`` a micro-batch admits the messages of so many flushes; the sink then bounds each of them
    (``write_with_rejects(..., flush_rows=rows)``), as the consumers of a group flush side by side.
    A topic is bounded the same way by ``max_offsets_per_trigger``. With the minute's trigger of the sinks a batch is
    flushed by count or by time, whichever comes first.
    """
    if rows < rows_per_file:
        raise ValueError(f"files of {rows_per_file} messages cannot make batches of {rows}")
    return read_files(spark, path, schema, max_files_per_trigger=flushes * (rows // rows_per_file))


def decode_json(messages: DataFrame, schema: T.StructType = S.TRANSACTION_MESSAGE) -> DataFrame:
    """STR-02, STR-07: JSON payloads as columns; text that does not parse is kept in ``_corrupt``.

    The document is parsed once behind ``inline``, which later filters cannot be pushed through.
    """
    fields = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return messages.where(F.col("value").isNotNull()).select(F.inline(F.array(parsed)))


def decode_avro(messages: DataFrame, avro_schema: str, registry_framed: bool = True) -> DataFrame:
    """STR-02: Avro payloads as columns. Needs Spark's Avro module on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    start = REGISTRY_HEADER_BYTES + 1 if registry_framed else 1
    payload = F.substring("value", start, 2**31 - 1 - REGISTRY_HEADER_BYTES)
    record = from_avro(payload, avro_schema, {"mode": "PERMISSIVE"})
    return messages.where(F.col("value").isNotNull()).select(F.inline(F.array(record)))


def stamp_received(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """STR-03: arrival time, only where the message lacks one."""
    now = F.current_timestamp() if as_of is None else as_of
    present = F.col("received_at").cast("timestamp") if "received_at" in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn("received_at", F.coalesce(present, now.cast("timestamp")))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """STR-07: decoded rows and the texts that did not parse."""
    return df.where(F.col("_corrupt").isNull()).drop("_corrupt"), df.where(F.col("_corrupt").isNotNull()).select("_corrupt")


def event_time(df: DataFrame, column: str, out: str = "event_time") -> DataFrame:
    """Event time as an instant; watermarks reject zone-less timestamps."""
    source = df.schema[column].dataType
    parsed = F.try_to_timestamp(F.col(column)) if isinstance(source, T.StringType) else F.col(column).cast("timestamp")
    return df.withColumn(out, parsed)


# Keyed state off the heap, on the executors' disks, with a log of changes per batch in the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def deduplicate_stream(df: DataFrame, keys: Sequence[str], ts: str = "event_time", delay: str = "48 hours") -> DataFrame:
    """STR-08: first arrival per key. State of a key expires ``delay`` after its event time.

    The delay is how far copies, and rows out of order, may lie behind the newest row: copies within it are removed for
    certain, older rows are dropped, and no key older than it is held, so the state follows the delay and not the
    stream. State lives in RocksDB (set for the session, as streams read it when they start). Copies of one key meet in
    one task per micro-batch, so the batch size (``max_offsets_per_trigger``) bounds what a hot key brings together.
    """
    for name, value in STATE_STORE.items():
        df.sparkSession.conf.set(name, value)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def state_rows(query: StreamingQuery) -> int:
    """Most keys held by the stateful operators after any of the last batches."""
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    return max(held, default=0)


def batch_rows(query: StreamingQuery) -> int:
    """Most rows read by any of the last batches."""
    return max((p["numInputRows"] for p in query.recentProgress), default=0)


def fresh_only(df: DataFrame, ts: str, hours: int = 48, as_of: Column | None = None) -> DataFrame:
    """STR-09: messages not older than the limit."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.where(F.col(ts) >= now.cast("timestamp") - F.expr(f"INTERVAL {hours} HOUR"))


def with_arrival_parts(df: DataFrame, ts: str = "received_at", parts: Sequence[str] = TRANSACTION_PARTITIONS) -> DataFrame:
    """STR-05: partition columns as zero-padded texts."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    for part in parts:
        df = df.withColumn(part, F.date_format(ts, formats[part]))
    return df


def lake_writer(
    df: DataFrame,
    path: str,
    checkpoint: str,
    parts: Sequence[str] = TRANSACTION_PARTITIONS,
    once: bool = False,
) -> DataStreamWriter:
    """STR-04 .. STR-06: exactly-once Parquet sink, one micro-batch a minute (or all that is there, with ``once``)."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy(*parts)
        .outputMode("append")
    )
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")


def write_lake(df: DataFrame, path: str, checkpoint: str, parts: Sequence[str] = TRANSACTION_PARTITIONS, once: bool = False) -> StreamingQuery:
    return lake_writer(df, path, checkpoint, parts, once).start()


_MANIFEST = "stream string, batch bigint, folder string, accepted bigint, rejected bigint"


def write_with_rejects(
    df: DataFrame, rules: list[Rule], target: str, checkpoint: str, once: bool = False, flush_rows: int | None = None
) -> StreamingQuery:
    """STR-07, QC-26: valid rows and rejected rows (with the violated rules), committed together per micro-batch.

    One pass writes both sides of a batch to a new folder, then one manifest file names it with its counts; readers
    (``committed``) follow the manifests, so they never see half a batch. A manifest belongs to a batch of a stream, and a
    stream is known by the id in its checkpoint: a batch that runs twice finds its manifest and writes nothing, and a
    checkpoint begun again at the same path is another stream, which adds batches and overwrites none.

    With ``flush_rows`` every file is a flush of at most so many rows, and the manifest has a line for each of them.
    """
    checked = validate(df, rules)
    spark = df.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        stream = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        manifest = f"{target}/manifest/{stream}-{batch_id}"
        if _exists(spark, manifest):
            return
        folder, counts = f"{target}/data/{stream}-{batch_id}-{uuid.uuid4().hex}", Observation()
        rejected = F.size("violations") > 0
        seen = batch.observe(counts, F.count("*").alias("n"), F.count_if(rejected).alias("rejected"))
        writer = seen.withColumn("rejected", rejected).write.partitionBy("rejected")
        if flush_rows:
            writer.option("maxRecordsPerFile", flush_rows).parquet(folder)
            _flushes(spark, folder, stream, batch_id).coalesce(1).write.mode("overwrite").json(manifest)
            return
        writer.parquet(folder)
        n, bad = (counts.get[c] for c in ("n", "rejected"))
        row = [(stream, batch_id, folder, n - bad, bad)]
        spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("overwrite").json(manifest)

    writer = checked.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")
    return writer.start()


def _flushes(spark: SparkSession, folder: str, stream: str, batch_id: int) -> DataFrame:
    """A manifest line per file of a batch's folder; a batch without rows has one line too."""
    files = spark.read.schema("rejected boolean").parquet(folder).groupBy(F.col("_metadata.file_path").alias("file"), "rejected")
    sizes = files.agg(F.count("*").alias("n"))
    one = spark.range(1).join(sizes, F.lit(True), "left")
    side = lambda bad: F.when(F.col("rejected") == bad, F.col("n")).otherwise(0).cast("bigint")
    return one.select(
        F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch"), F.lit(folder).alias("folder"),
        side(False).alias("accepted"), side(True).alias("rejected"),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to the end."""
    try:
        return not spark.read.schema(_MANIFEST).json(path).isEmpty()
    except AnalysisException:
        return False


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """The committed batches, or the flushes of them: stream, batch, folder, accepted and rejected rows."""
    return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(f"{target}/manifest")


def committed(spark: SparkSession, target: str, schema: T.StructType, rejected: bool = False) -> DataFrame:
    """Accepted rows, or rejected rows with their violations, of the committed batches. The list of batches, one short row
    each, passes the driver; ``compact`` keeps it short."""
    side = "rejected" if rejected else "accepted"
    folders = [r["folder"] for r in manifests(spark, target).where(f"{side} > 0").select("folder").distinct().collect()]
    kept = T.StructType([*schema.fields, *([T.StructField("violations", T.ArrayType(T.StringType()))] if rejected else [])])
    if not folders:
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).parquet(*[f"{f}/rejected={str(rejected).lower()}" for f in folders])


def topic_to_table(
    messages: DataFrame,
    decode: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """STR-11: topic rows into a table folder; tombstones (NULL payloads) are ignored, an error stops the query."""
    decoded = decode(messages.where(F.col("value").isNotNull()))
    writer = decoded.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")
    return writer.start()


def compact(spark: SparkSession, path: str, where: str, target: str, rows_per_file: int = 1_000_000) -> None:
    """Rewrite closed partitions of a lake, whose minute batches leave many small files, into a new folder."""
    rows = spark.read.parquet(path).where(where)
    parts = [c for c in TRANSACTION_PARTITIONS if c in rows.columns]
    (
        rows.repartition(*parts, F.pmod(F.xxhash64(*[c for c in rows.columns if c not in parts]), F.lit(8)))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*parts)
        .parquet(target)
    )
