"""Record logs derived from the given tables. Every frame grows with its table; none is cut or sampled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.functions import by_payload_field, raw_bytes, time_key
from harborlog.operators import (
    MessageType,
    chunk_bases,
    commit_log,
    encode,
    file_plan,
    rotate_by_count,
    with_directory,
)
from harborlog.plans import ranked, stored
from harborlog.sources import TOPIC_PARTITION, from_log_source

FLUSH_SIZE = 1000
ROTATE_FLUSH_SIZE = 20
ROTATE_INTERVAL_MS = 21_600_000
WIDTH = 1 << 14
BASE = "hdfs://data"
TOPICS_DIR = "topics"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one topic with four partitions and offsets from 0 without gaps."""
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("protocol"),
        "value",
        "props",
    )
    numbered = ranked(events, TOPIC_PARTITION, "event_id", "_rank", WIDTH)
    return numbered.withColumn("kafka_offset", F.col("_rank") - 1).drop("_rank")


def millis(ts: Column) -> Column:
    """Epoch milliseconds, truncated, of a zone-less timestamp; the session zone is UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics as Spark's topic-log source delivers them, put into the envelope."""
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("_order"),
        F.when(F.col("event_id") % 101 != 0, raw_bytes(F.col("props"))).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("topic"),
        (F.col("o_custkey") % 3).cast("int").alias("partition"),
        F.col("o_orderkey").alias("_order"),
        raw_bytes(F.col("o_orderpriority")).alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("topic"),
        (F.col("doc_id") % 2).cast("int").alias("partition"),
        F.col("doc_id").alias("_order"),
        raw_bytes(F.col("text")).alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    messages = events.unionByName(orders).unionByName(documents)
    numbered = ranked(messages, ["topic", "partition"], "_order", "_rank", WIDTH)
    return from_log_source(
        numbered.withColumn("offset", F.col("_rank") - 1).withColumn("key", time_key(F.col("_order")))
    )


def message() -> MessageType:
    """A made-up message with every field optional and one repeated field."""
    from google.protobuf import descriptor_pb2 as pb

    field = pb.FieldDescriptorProto
    file = pb.FileDescriptorProto(name="fixture.proto", package="fixture", syntax="proto2")
    event = file.message_type.add(name="Event")
    fields = [
        ("protocol", field.TYPE_STRING),
        ("event_id", field.TYPE_INT64),
        ("ts_millis", field.TYPE_INT64),
        ("user_id", field.TYPE_INT64),
        ("value", field.TYPE_DOUBLE),
        ("props", field.TYPE_STRING),
    ]
    for number, (name, kind) in enumerate(fields, start=1):
        event.field.add(name=name, number=number, type=kind, label=field.LABEL_OPTIONAL)
    event.field.add(name="tags", number=7, type=field.TYPE_STRING, label=field.LABEL_REPEATED)
    return MessageType(pb.FileDescriptorSet(file=[file]).SerializeToString(), "fixture.Event")


def records(spark: SparkSession, sf_dir: str, protocol: Column | None = None) -> DataFrame:
    """``rec`` as an envelope whose value is a message; ``event_id`` and ``ts`` stay for checks."""
    rows = rec(spark, sf_dir)
    value = encode(
        message(),
        {
            "protocol": F.col("protocol") if protocol is None else protocol,
            "event_id": F.col("event_id"),
            "ts_millis": millis(F.col("ts")),
            "user_id": F.col("user_id"),
            "value": F.col("value"),
            "props": F.col("props"),
            "tags": F.split("props", " "),
        },
    )
    return rows.select(
        *TOPIC_PARTITION,
        "kafka_offset",
        time_key(F.col("event_id")).alias("key"),
        value.alias("value"),
        "event_id",
        "ts",
    )


def records_unset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth message has no protocol, every tenth an empty one."""
    last = F.col("event_id") % 10
    protocol = F.when(last == 0, F.lit(None)).when(last == 1, F.lit("")).otherwise(F.col("protocol"))
    return records(spark, sf_dir, protocol)


def records_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some values are a truncated field, some are null."""
    value = (
        F.when(F.col("event_id") % 97 == 0, F.unhex(F.lit("0AFF")))
        .when(F.col("event_id") % 101 == 0, F.lit(None))
        .otherwise(F.col("value"))
    )
    return records(spark, sf_dir).withColumn("value", value)


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each 500 records of a partition, the last 50 are delivered again."""
    passes = F.when(F.col("kafka_offset") % 500 >= 450, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rec(spark, sf_dir).select(*TOPIC_PARTITION, "kafka_offset", F.explode(passes).alias("_pass"))
    order = F.expr("(kafka_offset div 500) * 1000 + _pass * 500 + kafka_offset % 500")
    numbered = ranked(rows.withColumn("_order", order), TOPIC_PARTITION, "_order", "_rank", WIDTH)
    return numbered.select(
        *TOPIC_PARTITION, "kafka_offset", (F.col("_rank") - 1).alias("arrival_seq")
    )


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 333rd offset is missing."""
    return (
        rec(spark, sf_dir)
        .where(F.col("kafka_offset") % 333 != 332)
        .select(*TOPIC_PARTITION, "kafka_offset", F.col("kafka_offset").alias("arrival_seq"))
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rec`` delivered hour by hour; the clock of a batch is the end of its hour."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return rec(spark, sf_dir).select(
        *TOPIC_PARTITION, "kafka_offset", (F.unix_millis(hour) + 3_600_000).alias("now_ms")
    )


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rec`` routed by protocol and cut every ``FLUSH_SIZE`` records."""
    rows = rec(spark, sf_dir)
    routed = with_directory(rows, by_payload_field("protocol"))
    return rotate_by_count(routed, FLUSH_SIZE, chunk_bases(rows))


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_plan(chunked(spark, sf_dir), FLUSH_SIZE)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planned files of complete chunks, as a manifest on disk."""
    return stored(plan(spark, sf_dir).where("complete"))


def log(files: DataFrame) -> DataFrame:
    """The commit log of planned files; every third chunk lacks its END."""
    return commit_log(with_temp(files).withColumn("ended", F.col("chunk") % 3 != 2))


def with_temp(files: DataFrame) -> DataFrame:
    temp = F.format_string(
        "+tmp/%s/%d-%d_tmp.parquet", F.col("directory"), F.col("kafka_partition"), F.col("chunk")
    )
    return files.withColumn("temp_file", temp)


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths around each planned file: good names, names with odd parts, and files in progress."""
    stem = F.format_string(
        "%s+%d+%d+%d", F.col("topic"), F.col("kafka_partition"), F.col("start_offset"), F.col("end_offset")
    )
    variants = F.array(
        F.col("committed_file"),
        F.concat(F.lit("a.b-"), F.col("committed_file")),
        stem,
        F.concat(stem, F.lit("xparquet")),
        F.concat(stem, F.lit(".a.b")),
        F.format_string("%s+%d+%010d+1%012d.seq", *[F.col(c) for c in (*TOPIC_PARTITION, "start_offset", "end_offset")]),
        F.concat(stem, F.lit("_tmp.parquet")),
        F.concat(F.lit("+tmp/"), F.col("committed_file")),
    )
    paths = plan(spark, sf_dir).select(
        F.concat_ws("/", F.lit("topics"), F.col("directory")).alias("directory"), F.explode(variants).alias("tail")
    )
    path = F.when(F.col("tail").startswith("+tmp/"), F.concat(F.lit("topics/"), F.col("tail"))).otherwise(
        F.concat_ws("/", F.col("directory"), F.col("tail"))
    )
    return paths.select(
        path.alias("path"), F.regexp_replace("tail", r"^\+tmp/", "").alias("file_name")
    )
