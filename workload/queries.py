"""The registered queries. Each takes (spark, directory of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog import IngestConfig, sources
from harborlog import functions as H
from harborlog import operators as O
from harborlog.plans import new_folder, ship, stored
from harborlog.sinks import Fenced, Part, SequenceFormat
from harborlog.sinks.paths import copy_file
from harborlog.sources import (
    ENVELOPE,
    TOPIC_PARTITION,
    committed_files,
    compact_manifest,
    leaf_directories,
    list_files,
    read_manifest,
    read_sequence,
    rebuild_manifest,
)
from harborlog.streaming import ingest_batch, start_accept, start_ingest
from harborlog.streaming import stream_accept as accept_stream
from workload import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OFFSET = [*TOPIC_PARTITION, "kafka_offset"]
DELIVERIES = 3
BATCHES = 20


def registered(build: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Times are zone-less in the tables and are read as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = query
    return build


# Sources ------------------------------------------------------------------------------------------------------


@registered
def records_scan(spark, sf_dir):
    return X.topics(spark, sf_dir).select(
        *OFFSET, F.hex("key").alias("key_hex"), F.octet_length("value").cast("bigint").alias("value_bytes"), "ingest_ts"
    ).withColumn("ingest_ms", F.unix_millis("ingest_ts")).drop("ingest_ts")


@registered
def route_counts(spark, sf_dir):
    return sources.route_counts(X.topics(spark, sf_dir))


@registered
def raw_bytes(spark, sf_dir):
    return X.topics(spark, sf_dir).select(
        *OFFSET, F.hex("key").alias("key_hex"), F.md5("value").alias("value_md5")
    )


@registered
def leaf_dirs(spark, sf_dir):
    return leaf_directories(X.names(spark, sf_dir))


# Projections --------------------------------------------------------------------------------------------------


@registered
def decode_payload(spark, sf_dir):
    rows = O.decoded(O.decode(X.records_corrupt(spark, sf_dir), X.message(), O.PERMISSIVE))
    return rows.select(*OFFSET, "payload.*").withColumn("tags", F.array_join("tags", "|"))


@registered
def dead_letter(spark, sf_dir):
    rows = O.dead_letters(O.decode(X.records_corrupt(spark, sf_dir), X.message(), O.PERMISSIVE))
    return rows.select(*OFFSET, F.hex("value").alias("value_hex"), "decode_error")


@registered
def reencode_payload(spark, sf_dir):
    rows = X.records(spark, sf_dir)
    again = rows.withColumn("value", O.reencode(X.message(), F.col("value")))
    return O.decode(again, X.message()).select(
        *OFFSET, "payload.event_id", "payload.protocol", "payload.props", "payload.ts_millis"
    )


@registered
def time_key(spark, sf_dir):
    return X.rec(spark, sf_dir).select(
        *OFFSET, F.hex(H.time_key(X.millis(F.col("ts")))).alias("key_hex")
    )


@registered
def encode_default(spark, sf_dir):
    return _encoded(X.rec(spark, sf_dir), H.by_kafka_partition())


@registered
def encode_protocol(spark, sf_dir):
    decoded = O.decode(X.records_unset(spark, sf_dir), X.message(), O.PERMISSIVE)
    return _encoded(decoded, H.by_payload_field())


@registered
def encode_field(spark, sf_dir):
    return _encoded(X.rec(spark, sf_dir), H.by_field("user_id"))


@registered
def encode_time(spark, sf_dir):
    by_hour = H.by_time(
        X.millis(F.col("ts")), 3_600_000, "'year'=YYYY/'month'=MM/'day'=dd/'hour'=HH/'half'=mm/", "Asia/Tehran"
    )
    return _encoded(X.rec(spark, sf_dir), by_hour)


@registered
def encode_custom(spark, sf_dir):
    return _encoded(
        X.rec(spark, sf_dir), lambda records: F.concat_ws("/", records["protocol"], (F.col("user_id") % 10).cast("string"))
    )


def _encoded(records: DataFrame, partitioner: H.partitioners.Partitioner) -> DataFrame:
    return O.with_directory(records, partitioner).select(*OFFSET, "encoded_partition")


@registered
def partition_path(spark, sf_dir):
    routed = O.with_directory(X.rec(spark, sf_dir), H.by_kafka_partition())
    directory = H.relative_directory(F.col("topic"), F.col("encoded_partition"))
    return routed.groupBy(*TOPIC_PARTITION, "encoded_partition").agg(F.count("*").alias("n_records")).select(
        *TOPIC_PARTITION,
        "n_records",
        directory.alias("relative"),
        H.topic_directory(X.BASE, X.TOPICS_DIR, F.col("topic")).alias("topic_directory"),
        H.directory_path(X.BASE, X.TOPICS_DIR, directory).alias("directory"),
        H.joined_path(X.BASE, X.TOPICS_DIR, directory, F.lit("f.parquet")).alias("file"),
        H.log_path(X.BASE, "logs", F.col("topic"), F.col("kafka_partition")).alias("log"),
    )


@registered
def committed_name(spark, sf_dir):
    def name(extension, width):
        return H.committed_name(
            F.col("topic"), F.col("kafka_partition"), F.col("start_offset"), F.col("end_offset"), extension, width
        )

    return X.plan(spark, sf_dir).select(
        name(".parquet", 10).alias("padded"), name(".seq", 2).alias("narrow"), name("", 0).alias("bare")
    )


@registered
def parse_committed(spark, sf_dir):
    parsed = H.parsed_name(F.col("file_name"))
    return X.names(spark, sf_dir).select("path", parsed.alias("parsed")).select("path", "parsed.*")


# Filters ------------------------------------------------------------------------------------------------------


@registered
def filter_committed(spark, sf_dir):
    return X.names(spark, sf_dir).where(H.is_committed(F.col("file_name")))


@registered
def filter_topic(spark, sf_dir):
    return X.names(spark, sf_dir).where(H.of_topic(F.col("file_name"), "a.b-events"))


@registered
def filter_topic_partition(spark, sf_dir):
    return X.names(spark, sf_dir).where(H.of_topic_partition(F.col("file_name"), "events", 2))


@registered
def filter_end_offset(spark, sf_dir):
    return X.names(spark, sf_dir).where(H.has_end_offset(F.col("file_name"), 999))


@registered
def exclude_temp(spark, sf_dir):
    return X.names(spark, sf_dir).where(~H.is_temporary(F.col("path")))


@registered
def accept_strict(spark, sf_dir):
    return O.accept_strict(X.redelivered(spark, sf_dir))


@registered
def accept_strict_gapped(spark, sf_dir):
    return O.accept_strict(X.gapped(spark, sf_dir))


@registered
def accept_monotonic(spark, sf_dir):
    return O.accept_monotonic(X.redelivered(spark, sf_dir))


@registered
def accept_monotonic_gapped(spark, sf_dir):
    return O.accept_monotonic(X.gapped(spark, sf_dir))


@registered
def resume_filter(spark, sf_dir):
    positions = O.committed_positions(X.published(spark, sf_dir))
    return O.resume(X.rec(spark, sf_dir), positions).select(*OFFSET, "event_id")


@registered
def redelivery(spark, sf_dir):
    positions = O.committed_positions(X.published(spark, sf_dir))
    rewound = O.resume(X.redelivered(spark, sf_dir), positions)
    return O.accept_strict(rewound, positions)


@registered
def publish_pending(spark, sf_dir):
    plan = stored(X.plan(spark, sf_dir))
    existing = plan.where(F.col("chunk") % 2 == 0)
    return O.publish_pending(plan, existing).select(*TOPIC_PARTITION, "chunk", "committed_file")


# Aggregates ---------------------------------------------------------------------------------------------------


@registered
def file_plan(spark, sf_dir):
    return X.plan(spark, sf_dir)


@registered
def max_offset_file(spark, sf_dir):
    files = committed_files(X.names(spark, sf_dir)).where("extension <> '.seq'")
    return O.files_with_max_offset(files)


@registered
def committed_positions(spark, sf_dir):
    assignment = sources.route_counts(X.topics(spark, sf_dir))
    return O.committed_positions(X.published(spark, sf_dir), assignment)


@registered
def uncommitted_counts(spark, sf_dir):
    positions = O.committed_positions(X.published(spark, sf_dir))
    return O.uncommitted_counts(X.rec(spark, sf_dir), positions)


# Rotation -----------------------------------------------------------------------------------------------------


@registered
def rotate_by_count(spark, sf_dir):
    return O.rotate_by_count(X.rec(spark, sf_dir), X.FLUSH_SIZE).select(*OFFSET, "chunk")


@registered
def rotate_by_count_gapped(spark, sf_dir):
    return O.rotate_ranked(O.accept_monotonic(X.gapped(spark, sf_dir)), X.FLUSH_SIZE).select(*OFFSET, "chunk")


@registered
def rotate_by_time(spark, sf_dir):
    rotated = O.rotate(X.batches(spark, sf_dir), "now_ms", interval_ms=X.ROTATE_INTERVAL_MS)
    return rotated.select(*OFFSET, "chunk")


@registered
def rotate_combined(spark, sf_dir):
    rotated = O.rotate(X.batches(spark, sf_dir), "now_ms", X.ROTATE_FLUSH_SIZE, X.ROTATE_INTERVAL_MS)
    return rotated.select(*OFFSET, "chunk")


@registered
def rotation_tail(spark, sf_dir):
    tail = X.plan(spark, sf_dir).where(~F.col("complete"))
    return tail.groupBy(*TOPIC_PARTITION, "chunk").agg(
        F.count("*").alias("n_files"), F.sum("n_records").alias("n_records")
    )


# Order --------------------------------------------------------------------------------------------------------


@registered
def file_order(spark, sf_dir):
    return O.file_order(X.chunked(spark, sf_dir)).select(*O.FILE_KEY, "kafka_offset", "event_id", "place")


@registered
def name_order(spark, sf_dir):
    return X.plan(spark, sf_dir).select("committed_file", "start_offset").orderBy("committed_file")


# Commit log ---------------------------------------------------------------------------------------------------


@registered
def commitlog_entries(spark, sf_dir):
    return X.log(stored(X.plan(spark, sf_dir)))


@registered
def commitlog_replay(spark, sf_dir):
    plan = stored(X.plan(spark, sf_dir))
    files = X.with_temp(plan)
    existing = files.where(F.col("chunk") % 2 == 0)
    sources = files.where((F.col("kafka_partition") != 3) | (F.col("encoded_partition") != "error"))
    return O.replay(X.log(plan), existing, sources)


# Files and streams --------------------------------------------------------------------------------------------


def _published(spark: SparkSession, sf_dir: str, **settings) -> IngestConfig:
    """Publish the records of ``events`` into a new folder in one batch."""
    config = IngestConfig(base_path=new_folder(spark, "published"), flush_size=X.FLUSH_SIZE, **settings)
    ingest_batch(X.records(spark, sf_dir).select(*ENVELOPE.names), 0, config, X.message())
    return config


def _relative(path: str):
    return F.concat(F.lit("topics/"), F.substring_index(path, "/topics/", -1))


@registered
def list_committed(spark, sf_dir):
    config = _published(spark, sf_dir, partitioner="protocol", publish_tail=False)
    files = committed_files(list_files(spark, config.topics_root))
    return files.select(_relative("path").alias("path"), *TOPIC_PARTITION, "start_offset", "end_offset")


@registered
def manifest_rebuilt(spark, sf_dir):
    config = _published(spark, sf_dir, partitioner="protocol")
    rebuilt = rebuild_manifest(spark, config.topics_root)
    return rebuilt.select(*TOPIC_PARTITION, "encoded_partition", "start_offset", "end_offset", "committed_file")


@registered
def read_committed(spark, sf_dir):
    config = _published(spark, sf_dir, partitioner="protocol")
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "start_offset", "end_offset", "event_id", "protocol")


@registered
def parquet_sink_roundtrip(spark, sf_dir):
    config = _published(spark, sf_dir)
    rows = sources.read_committed(spark, config.topics_root)
    payload = ["event_id", "protocol", "user_id", "ts_millis", "value", "props"]
    return rows.select(*TOPIC_PARTITION, *payload, F.array_join("tags", "|").alias("tags"))


@registered
def sequence_sink_roundtrip(spark, sf_dir):
    clock = X.millis(F.lit("2024-02-01 00:00:00").cast("timestamp"))
    config = _published(spark, sf_dir, format=SequenceFormat(clock=clock))
    pairs = read_sequence(spark, config.topics_root)
    rows = O.decode(pairs, X.message())
    return rows.select(
        F.hex("key").alias("key_hex"), "payload.event_id", "payload.protocol", "payload.props"
    )


@registered
def read_committed_sequence(spark, sf_dir):
    """Published sequence files by the manifest, beside a file that no manifest lists and one in progress."""
    clock = X.millis(F.lit("2024-02-01 00:00:00").cast("timestamp"))
    config = _published(spark, sf_dir, format=SequenceFormat(clock=clock), partitioner="protocol")
    manifest = read_manifest(spark, config.manifest_root)
    first = manifest.agg(F.min("path")).first()[0]
    folder, name = first.rsplit("/", 1)
    topic, kafka_partition, *_ = name.split("+")
    copy_file(first, f"{folder}/{topic}+{kafka_partition}+0000000001+0000000002.seq")
    copy_file(first, f"{config.topics_root}/+tmp/{topic}/{name}")
    rows = O.decode(read_sequence(spark, config.topics_root, manifest), X.message())
    return rows.select(*TOPIC_PARTITION, "start_offset", "end_offset", "payload.event_id", "payload.protocol")


@registered
def exactly_once_ingest(spark, sf_dir):
    """Batches that overlap, are replayed, and are replayed after a failure between publishing and committing."""
    folder = new_folder(spark, "exactly-once")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    records = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")
    first, second = records.where("kafka_offset < 1300"), records.where("kafka_offset >= 800")

    def fail(step: str) -> None:
        if step == "published":
            raise InterruptedError(step)

    ingest_batch(first, 0, config, X.message())
    ingest_batch(first, 0, config, X.message())
    try:
        ingest_batch(second, 1, config, X.message(), on_step=fail)
    except InterruptedError:
        pass
    ingest_batch(second, 1, config, X.message())
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def manifest_addressed(spark, sf_dir):
    """Overlapping and replayed batches published in place: no file is renamed, and one put commits a batch."""
    folder = new_folder(spark, "direct")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    log = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol", publish="direct")

    def fail(step: str) -> None:
        if step == "recorded":
            raise InterruptedError(step)

    first, second = log.where("kafka_offset < 1300"), log.where("kafka_offset >= 800")
    ingest_batch(first, 0, config, X.message())
    ingest_batch(first, 0, config, X.message())
    try:
        ingest_batch(second, 1, config, X.message(), on_step=fail)
    except InterruptedError:
        pass
    ingest_batch(second, 1, config, X.message())
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def manifest_compacted(spark, sf_dir):
    """The file plan as the manifest of many batches, merged as they come, read through the runs and the newest parts."""
    root = f"{new_folder(spark, 'manifest')}/manifest"
    columns = [*TOPIC_PARTITION, "encoded_partition", "start_offset", "end_offset", "n_records", "committed_file"]
    plan = X.published(spark, sf_dir).select(*columns, F.lit("").alias("path"))
    plan = stored(plan.withColumn("batch", F.pmod(F.xxhash64("committed_file"), F.lit(BATCHES))))
    for batch_id in range(BATCHES):
        part = Part(root, "plan", batch_id)
        part.write(plan.where(F.col("batch") == batch_id).drop("batch"))
        part.commit()
        compact_manifest(spark, root, "plan", fan_in=3)
    return read_manifest(spark, root).select(*columns)


@registered
def stream_ingest(spark, sf_dir):
    """The log arrives in three deliveries that overlap; the stream is restarted for each."""
    folder = new_folder(spark, "stream")
    records = X.records(spark, sf_dir).select(*ENVELOPE.names)
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")
    for log in _deliveries(records, "kafka_offset", folder, overlap=50):
        query = start_ingest(log, config, f"{folder}/checkpoint", X.message(), availableNow=True)
        query.awaitTermination()
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def stream_rotation(spark, sf_dir):
    """Files stay open over deliveries that are no multiples of a file, and only full ones are published."""
    folder = new_folder(spark, "rotation")
    records = X.records(spark, sf_dir).select(*ENVELOPE.names)
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol", publish_tail=False)
    for log in _deliveries(records, "kafka_offset", folder):
        start_ingest(log, config, f"{folder}/checkpoint", X.message(), availableNow=True).awaitTermination()
    files = read_manifest(spark, config.manifest_root)
    return files.select(*TOPIC_PARTITION, "encoded_partition", "start_offset", "end_offset", "n_records", "committed_file")


@registered
def resume_new_checkpoint(spark, sf_dir):
    """The checkpoint is lost after two deliveries; a query with a new one reads the log from its start."""
    folder = new_folder(spark, "checkpoint")
    records = X.records(spark, sf_dir).select(*ENVELOPE.names)
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")
    for turn, log in enumerate(_deliveries(records, "kafka_offset", folder)):
        start_ingest(log, config, f"{folder}/checkpoint-{turn // 2}", X.message(), availableNow=True).awaitTermination()
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def follow_committed(spark, sf_dir):
    """Ingests of two streams, followed batch by batch while they come; the follower is restarted for each."""
    folder = new_folder(spark, "follow")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    log = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")
    steps = [("a", 0, log.where("kafka_partition < 2 and kafka_offset < 700")), ("b", 0, log.where("kafka_partition >= 2")), ("a", 1, log.where("kafka_partition < 2"))]
    for stream, batch_id, rows in steps:
        ingest_batch(rows, batch_id, config, X.message(), query_id=stream)
        published = sources.follow_committed(
            spark, config.manifest_root, "event_id bigint, protocol string, props string", batches_per_trigger=1, progress=f"{folder}/progress"
        )
        writer = published.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint")
        writer.format("parquet").start(f"{folder}/followed").awaitTermination()
    return spark.read.schema(published.schema).parquet(f"{folder}/followed").select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def tail_drained(spark, sf_dir):
    """A batch holds its tail back; from the next one on tails are published, over three batches."""
    folder = new_folder(spark, "drained")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    log = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    settings = {"base_path": f"{folder}/out", "flush_size": X.FLUSH_SIZE, "partitioner": "protocol"}
    edges = [0, 333, 347, 1411]
    for batch_id, (low, high) in enumerate(zip(edges, [*edges[1:], None])):
        config = IngestConfig(**settings, publish_tail=batch_id > 0)
        part = log.where(F.col("kafka_offset") >= low)
        ingest_batch(part if high is None else part.where(F.col("kafka_offset") < high), batch_id, config, X.message())
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def crash_before_manifest(spark, sf_dir):
    """A batch fails just before it is committed and its checkpoint is lost; a new query reads the log in other batches."""
    folder = new_folder(spark, "crash")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    log = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")

    def fail(step: str) -> None:
        if step == "recorded":
            raise InterruptedError(step)

    ingest_batch(log.where("kafka_offset < 120"), 0, config, X.message(), query_id="lost")
    try:
        ingest_batch(log.where("kafka_offset < 777"), 1, config, X.message(), query_id="lost", on_step=fail)
    except InterruptedError:
        pass
    ingest_batch(log.where("kafka_offset < 500"), 0, config, X.message(), query_id="new")
    ingest_batch(log, 1, config, X.message(), query_id="new")
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def fenced_writers(spark, sf_dir):
    """A second query takes over half of the topic-partitions while the first is about to commit a batch of all of them."""
    folder = new_folder(spark, "fenced")
    X.records(spark, sf_dir).select(*ENVELOPE.names).write.parquet(f"{folder}/log")
    log = spark.read.schema(ENVELOPE).parquet(f"{folder}/log")
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")

    def overtake(step: str) -> None:
        if step == "recorded":
            ingest_batch(log.where("kafka_partition < 2 and kafka_offset < 900"), 0, config, X.message(), query_id="new")

    ingest_batch(log.where("kafka_offset < 400"), 0, config, X.message(), query_id="old")
    try:
        ingest_batch(log.where("kafka_offset < 1300"), 1, config, X.message(), query_id="old", on_step=overtake)
    except Fenced:
        pass
    ingest_batch(log.where("kafka_partition < 2"), 1, config, X.message(), query_id="new")
    ingest_batch(log.where("kafka_partition >= 2"), 1, config, X.message(), query_id="old")
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def replay_time_partitioned(spark, sf_dir):
    """A batch routed by the clock fails between publishing and committing, and is replayed a day later."""
    folder = new_folder(spark, "replay")
    X.records(spark, sf_dir).select(*ENVELOPE.names).drop("ingest_ts").write.parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    config = IngestConfig(
        base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="time", partition_duration_ms=3_600_000, path_format="yyyy-MM-dd-HH"
    )

    def fail(step: str) -> None:
        if step == "published":
            raise InterruptedError(step)

    try:
        ingest_batch(log, 0, config, X.message(), on_step=fail, clock_ms=1_706_745_600_000)
    except InterruptedError:
        pass
    ingest_batch(log, 0, config, X.message(), clock_ms=1_706_832_000_000)
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def ingest_duplicates(spark, sf_dir):
    """In each topic-partition one record is missing and another comes twice, so that the count fits the range."""
    folder = new_folder(spark, "duplicates")
    records = X.records(spark, sf_dir).select(*ENVELOPE.names)
    twice = records.where("kafka_offset <> 40").unionByName(records.where("kafka_offset = 30"))
    config = IngestConfig(base_path=f"{folder}/out", flush_size=X.FLUSH_SIZE, partitioner="protocol")
    ingest_batch(twice, 0, config, X.message())
    rows = sources.read_committed(spark, config.topics_root, manifest=read_manifest(spark, config.manifest_root))
    return rows.select(*TOPIC_PARTITION, "event_id", "protocol", "props")


@registered
def stream_accept(spark, sf_dir):
    """The redelivered log in deliveries, accepted batch by batch; the stream is restarted for each."""
    folder = new_folder(spark, "accept")
    for log in _deliveries(X.redelivered(spark, sf_dir), "arrival_seq", folder):
        start_accept(log, folder, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    columns = [*OFFSET, "arrival_seq"]
    return spark.read.parquet(f"{folder}/accepted").select(columns)


@registered
def stream_accept_stateful(spark, sf_dir):
    """The same with the stateful operator; its task holds two numbers per record of a delivery."""
    folder = new_folder(spark, "stateful")
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", rocks)
    for log in _deliveries(X.redelivered(spark, sf_dir), "arrival_seq", folder):
        # Deliveries keep the order of arrival.
        writer = accept_stream(log).writeStream.format("parquet").trigger(availableNow=True)
        query = writer.option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/accepted")
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/accepted")


def _deliveries(records: DataFrame, position: str, folder: str, overlap: int = 0):
    """Append a log to a folder part by part, in order of ``position``, and stream the folder after each part."""
    spark = records.sparkSession
    # Ranges of positions per file let each part read only its own files.
    records.repartitionByRange(position).write.parquet(f"{folder}/whole")
    whole = spark.read.schema(records.schema).parquet(f"{folder}/whole")
    end, parts = whole.agg(F.max(position)).first()[0] + 1, DELIVERIES
    for part in range(parts):
        low, high = end * part // parts, end * (part + 1) // parts
        rows = whole.where((F.col(position) >= low - overlap) & (F.col(position) < high))
        rows.write.mode("append").parquet(f"{folder}/log")
        yield spark.readStream.schema(records.schema).parquet(f"{folder}/log")
