"""Exactly-once ingest of a record log into directories of files.

The position of each topic-partition is part of what a batch commits, so a replayed batch starts from where it started
the first time, plans the same files, and finds those it already published.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harborlog.config import IngestConfig
from harborlog.functions import joined_path, partitioner_for
from harborlog.operators.acceptance import accept_monotonic, accept_strict
from harborlog.operators.files import FILE_KEY, file_plan, with_directory
from harborlog.operators.payload import FAILFAST, MessageType, dead_letters, decode, decoded, reencode
from harborlog.operators.positions import resume
from harborlog.plans import Scratch, bounded, ranked, stored
from harborlog.sinks import paths
from harborlog.sinks.claims import Claims, Fenced
from harborlog.sinks.direct import write_committed
from harborlog.sinks.formats import OutputFormat, format_for
from harborlog.sinks.publish import Part, publish
from harborlog.sources.envelope import TOPIC_PARTITION
from harborlog.sources.manifest import compact_manifest, is_covered, read_manifest
from harborlog.streaming.positions import Positions


HELD = "_held"
HELD_BACK = "held"


def start_ingest(
    stream: DataFrame,
    config: IngestConfig,
    checkpoint: str,
    message: MessageType | None = None,
    mode: str = FAILFAST,
    dead_letter_root: str | None = None,
    arrival: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Ingest a stream of envelopes, one micro-batch after another.

    With ``publish_tail`` each micro-batch closes its files. Without it, files stay open over micro-batches until
    ``flush_size`` records or ``rotate_interval_ms`` close them, and what an open file has so far is held beside the log.
    ``trigger`` is passed on, for example ``availableNow=True`` or ``processingTime="10 seconds"``; with
    ``rotate_interval_ms`` set and no trigger, that interval is used.

    What a batch commits is kept under the id of the query, which its checkpoint keeps. A query with a new checkpoint
    therefore starts anew, after everything that is published; the two never touch each other's parts.
    """
    if not trigger and config.rotate_interval_ms > 0:
        trigger = {"processingTime": f"{config.rotate_interval_ms} milliseconds"}

    def each(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or _query_id(checkpoint)
        ingest_batch(batch, batch_id, config, message, mode, dead_letter_root, arrival, query_id=query)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    config: IngestConfig,
    message: MessageType | None = None,
    mode: str = FAILFAST,
    dead_letter_root: str | None = None,
    arrival: str | None = None,
    on_step: Callable[[str], None] = lambda step: None,
    query_id: str = "",
    clock_ms: int | None = None,
) -> None:
    """Publish one batch. May be called again with the same batch and ``batch_id`` after any failure; once it is committed,
    that does nothing.

    Without ``arrival``, records count in order of offset, and one of each offset. ``on_step`` is called after each step:
    ``staged``, ``published``, ``recorded``, ``committed``. ``clock_ms`` is the time of the batch, by default that of its first attempt;
    it is committed before anything is published, so that a replay routes and closes files as before.

    A stream claims the topic-partitions it ingests. One that another stream has claimed since fails with ``Fenced`` before it
    commits, and from then on; it goes on as a new query, after everything published. So does a batch whose records others have
    published meanwhile; its replay starts after them.
    """
    spark = batch.sparkSession
    output = format_for(config.format)
    stream_id = f"{config.stream_id}-{query_id}" if query_id else config.stream_id
    attempts = f"{config.staging_root}/{stream_id}-{batch_id}"
    paths.delete_directory(attempts)  # left by attempts that failed
    part = Part(config.manifest_root, stream_id, batch_id, config.publish == "direct")
    if part.committed() or is_covered(config.manifest_root, stream_id, batch_id):
        return
    staging = f"{attempts}/{uuid.uuid4().hex}"
    positions = Positions(config.manifest_root, stream_id)
    noted = positions.others() if config.claims else {}
    before = bounded(positions.read(spark, batch_id))
    clock_ms = _clock(config, stream_id, batch_id, clock_ms)

    # Read and decode once; everything below works on this copy. Lost blocks are recomputed from the source.
    taken = before.select(*TOPIC_PARTITION, F.col("taken_offset").alias("next_offset"))
    fresh = resume(batch, taken, is_stored=True).withColumn(HELD, F.lit(False))
    held = _held(spark, positions, batch_id, fresh)
    delivered = fresh if held is None else fresh.unionByName(held)
    landed = _landed(delivered, config, output, message, mode, clock_ms).persist(StorageLevel.MEMORY_AND_DISK)
    scratch = Scratch(spark, "ingest")
    try:
        accepted, spans = _accept(landed, before, config, arrival, scratch)
        claims, claimed = None, []
        if config.claims:
            claims, claimed = Claims(config.claims_root, stream_id), [tuple(row) for row in spans.select(*TOPIC_PARTITION).collect()]
            claims.take(claimed)

        def keep_claims() -> None:
            if claims is not None:
                claims.check(claimed)
                if positions.overtaken(noted, before, spans):
                    raise Fenced(f"others have published what batch {batch_id} of {stream_id} was to publish")

        spans = _rotations(spans, config, clock_ms)
        numbered = _chunked(accepted, spans, config)
        chunked = numbered if config.publish_tail else numbered.where("chunk < _closed")
        left = None if config.publish_tail else stored(
            numbered.where("chunk >= _closed").select(*TOPIC_PARTITION, "kafka_offset"), scratch=scratch
        )
        chunked = chunked.drop("_closed", HELD)

        rows = chunked
        if "decode_error" in chunked.columns:
            rows = decoded(chunked)
            if dead_letter_root is not None:
                dead = Part(dead_letter_root, stream_id, batch_id)
                dead.write(dead_letters(chunked))
                dead.commit()
        if message is not None and _keeps_value(output):
            rows = rows.withColumn("value", reencode(message, F.col("value")))

        # Positions follow the records taken in, not the files: a dead letter at the end moves the position as well.
        ends = _ends(chunked, spans, config)
        if config.publish == "direct":
            _record(part, positions, delivered, left, ends, before)
            on_step("recorded")
            keep_claims()
            write_committed(rows, config.topics_root, part, output.extension, config.zero_pad_width, claims, claimed)
        else:
            files = stored(_files(rows, config, output.extension), scratch=scratch)
            staged = output.stage(rows, files, staging)
            on_step("staged")
            part.write(publish(files, staged))
            on_step("published")
            _record(part, positions, delivered, left, ends, before)
            on_step("recorded")
            keep_claims()
            part.commit()
        on_step("committed")
        positions.forget_before(batch_id)
        _forget_clocks(config, stream_id, batch_id)
        if config.compact_manifest:
            compact_manifest(spark, config.manifest_root, stream_id)
        paths.delete_directory(attempts)
    finally:
        landed.unpersist()
        scratch.delete()


def _record(part: Part, positions: Positions, delivered: DataFrame, left: DataFrame | None, ends: DataFrame, before: DataFrame) -> None:
    """Put held records and positions beside the manifest. All are committed at once, so none of them runs ahead of another."""
    if left is not None:
        part.attach(HELD_BACK, _hold(delivered, left))
    positions.advance(part, ends, before)


def published_files(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """The manifest of everything published under ``config``."""
    return read_manifest(spark, config.manifest_root)


def _keeps_value(output: OutputFormat) -> bool:
    return getattr(output, "needs_value", True)


def _landed(
    fresh: DataFrame, config: IngestConfig, output: OutputFormat, message: MessageType | None, mode: str, clock_ms: int
) -> DataFrame:
    """Decode and route, keeping no more than the format writes."""
    partitioner = partitioner_for(
        config.partitioner,
        config.partition_field,
        config.partition_duration_ms,
        config.path_format,
        config.timezone,
        config.locale,
        F.unix_millis("ingest_ts") if "ingest_ts" in fresh.columns else F.lit(clock_ms).cast("bigint"),
    )
    if message is None:
        return with_directory(fresh, partitioner)
    rows = with_directory(decode(fresh, message, mode), partitioner)
    if _keeps_value(output):
        return rows.drop("payload")
    if mode == FAILFAST:
        return rows.drop("key", "value")
    failed = F.col("decode_error").isNotNull()
    return rows.withColumns({name: F.when(failed, F.col(name)) for name in ("key", "value") if name in rows.columns})


def _accept(
    landed: DataFrame, before: DataFrame, config: IngestConfig, arrival: str | None, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows; and per topic-partition the first position, the offset range and the count of them."""

    def spans_of(rows: DataFrame) -> DataFrame:
        # Distinct offsets are counted by bitmaps, so that a duplicate can't make up for a gap.
        new = F.when(~F.col(HELD), F.col("kafka_offset"))
        bits = rows.groupBy(*TOPIC_PARTITION, F.bitmap_bucket_number("kafka_offset").alias("_bucket")).agg(
            F.min(new).alias("first"), F.max(new).alias("last"), F.count(new).alias("n"),
            F.min(F.when(F.col(HELD), F.col("kafka_offset"))).alias("held_first"), F.count(F.when(F.col(HELD), 1)).alias("carried"),
            F.bitmap_construct_agg(F.bitmap_bit_position("kafka_offset")).alias("_bits"),
        )
        edges = bits.groupBy(*TOPIC_PARTITION).agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.min("held_first").alias("held_first"),
            F.sum("carried").alias("carried"), (F.sum(F.bitmap_count("_bits")) - F.sum("carried")).alias("n_offsets"),
        )
        base = F.when(F.col("taken_offset") > 0, F.col("taken_offset")).otherwise(F.col("first"))
        known = before.select(*TOPIC_PARTITION, "taken_offset", "rotated_ms")
        return edges.join(known, TOPIC_PARTITION, "left").withColumn("base", base)

    spans = bounded(spans_of(landed))
    # A log that delivers each offset once needs no per-record check where its range has no gap.
    gap = "n > 0 and (n_offsets <> last - first + 1 or first <> base)"
    once = spans.where("n <> n_offsets").isEmpty()
    if arrival is None and once and (config.acceptance == "monotonic" or spans.where(gap).isEmpty()):
        return landed, spans.withColumn("n_dropped", F.lit(0).cast("bigint"))
    fresh = landed.where(~F.col(HELD))
    if arrival is None and not once:
        fresh = fresh.dropDuplicates([*TOPIC_PARTITION, "kafka_offset"])
    accept = accept_strict if config.acceptance == "strict" else accept_monotonic
    taken = before.select(*TOPIC_PARTITION, F.col("taken_offset").alias("next_offset"))
    accepted = accept(fresh, taken, arrival or "kafka_offset", scratch=scratch)
    accepted = accepted.select(landed.columns).unionByName(landed.where(HELD))
    after = spans_of(accepted)
    delivered = spans.select(*TOPIC_PARTITION, F.col("n").alias("_n"))
    counted = after.join(delivered, TOPIC_PARTITION, "right").withColumn("n_dropped", F.col("_n") - F.coalesce("n", F.lit(0)))
    return accepted, bounded(counted.drop("_n").withColumns({name: F.coalesce(name, F.lit(0)) for name in ("n", "carried")}))


def _rotations(spans: DataFrame, config: IngestConfig, clock_ms: int) -> DataFrame:
    """Per topic-partition what this batch does to its open file.

    The clock is looked at once per batch, when its first record is processed. Elapsed time then closes the open file
    with that record in it; the first record ever only starts the clock. Counts close files from there on.
    """
    since = F.coalesce("rotated_ms", F.lit(clock_ms).cast("bigint"))
    fired = (F.lit(config.rotate_interval_ms) > 0) & (F.col("n") > 0) & (F.lit(clock_ms) - since >= config.rotate_interval_ms)
    rows = spans.withColumn("fired", F.lit(False) if config.publish_tail else fired)
    closed = F.expr(
        f"case when fired then 1 + (n - 1) div {config.flush_size} else (carried + n) div {config.flush_size} end"
    ).cast("bigint")
    rows = rows.withColumn("_closed", F.coalesce(closed, F.lit(0).cast("bigint")))
    return rows.withColumn("rotated_ms", F.when(F.col("_closed") > 0, F.lit(clock_ms)).otherwise(since).cast("bigint"))


def _chunked(accepted: DataFrame, spans: DataFrame, config: IngestConfig) -> DataFrame:
    """Number the file of each record; ``_closed`` files of a topic-partition are full or due."""
    known = spans.select(*TOPIC_PARTITION, "first", "carried", "fired", "_closed")
    rows = accepted
    place = "(kafka_offset - first)"
    if config.acceptance != "strict":
        rows = ranked(accepted, TOPIC_PARTITION, "kafka_offset", "_rank")
        place = "(_rank - 1 - carried)"
    chunk = f"""case when {HELD} then 0
                     when not fired then (carried + {place}) div {config.flush_size}
                     when {place} = 0 then 0 else 1 + ({place} - 1) div {config.flush_size} end"""
    rows = rows.join(known, TOPIC_PARTITION).withColumn("chunk", F.coalesce(F.expr(chunk), F.lit(0)).cast("bigint"))
    return rows.drop("first", "carried", "fired", "_rank").withColumn("file_id", _file_id())


def _ends(chunked: DataFrame, spans: DataFrame, config: IngestConfig) -> DataFrame:
    """The positions after the batch: what is published, and what is taken in."""
    taken = F.col("last") + 1
    if config.publish_tail:
        ends = spans.withColumns({"next_offset": taken, "taken_offset": taken})
    else:
        published = chunked.groupBy(*TOPIC_PARTITION).agg((F.max("kafka_offset") + 1).alias("next_offset"))
        ends = spans.drop("taken_offset").join(published, TOPIC_PARTITION, "left").withColumn("taken_offset", taken)
    return ends.select(*TOPIC_PARTITION, "next_offset", "taken_offset", "rotated_ms", "n_dropped")


def _held(spark: SparkSession, positions: Positions, batch_id: int, like: DataFrame) -> DataFrame | None:
    """Records that the stream's last batch before this one held back: fewer than a file per topic-partition."""
    last = positions.last_before(batch_id)
    earlier = last.attached(HELD_BACK) if last is not None else None
    return None if earlier is None else spark.read.schema(like.schema).parquet(earlier)


def _hold(delivered: DataFrame, left: DataFrame) -> DataFrame:
    keep = delivered.join(left, [*TOPIC_PARTITION, "kafka_offset"], "left_semi").dropDuplicates([*TOPIC_PARTITION, "kafka_offset"])
    return keep.select(delivered.columns).withColumn(HELD, F.lit(True))


def _clock(config: IngestConfig, stream_id: str, batch_id: int, clock_ms: int | None) -> int:
    """The time of the batch, written down on its first attempt as the name of a folder."""
    folder = f"{config.clock_root}/stream_id={stream_id}/batch_id={batch_id}"
    known = [name for name in paths.subdirectories(folder) if name.startswith("at=")]
    if known:
        return int(min(known).removeprefix("at="))
    now = int(time.time() * 1000) if clock_ms is None else clock_ms
    paths.make_directory(f"{folder}/at={now:020d}")
    return now


def _forget_clocks(config: IngestConfig, stream_id: str, batch_id: int) -> None:
    folder = f"{config.clock_root}/stream_id={stream_id}"
    for name in paths.subdirectories(folder):
        if int(name.removeprefix("batch_id=")) < batch_id:
            paths.delete_directory(f"{folder}/{name}")


def _query_id(checkpoint: str) -> str:
    """A name for a checkpoint whose query's id isn't known."""
    return uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex


def _file_id() -> Column:
    return F.md5(F.to_json(F.struct(*FILE_KEY)))


def _files(rows: DataFrame, config: IngestConfig, extension: str) -> DataFrame:
    planned = file_plan(rows, config.flush_size, extension, config.zero_pad_width)
    path = joined_path(
        config.base_path.rstrip("/"), config.topics_dir, F.col("directory"), F.col("committed_file")
    )
    return planned.select(
        *TOPIC_PARTITION,
        "encoded_partition",
        "start_offset",
        "end_offset",
        "n_records",
        "committed_file",
        path.alias("path"),
        _file_id().alias("file_id"),
    )
