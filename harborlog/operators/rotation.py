"""Cut accepted records into files: number the ``chunk`` of each record.

A rotation closes all open files of a topic-partition together, so a chunk belongs to a topic-partition and its
records go to one file per directory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.plans import SLICE_WIDTH, ranked, stored
from harborlog.sources.envelope import TOPIC_PARTITION

NO_LIMIT = 1 << 62


def chunk_bases(accepted: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Offset at which chunk 0 starts: the committed position, else the first accepted offset."""
    firsts = accepted.groupBy(*TOPIC_PARTITION).agg(F.min("kafka_offset").alias("base"))
    if positions is None:
        return firsts
    known = positions.select(*TOPIC_PARTITION, F.col("next_offset").alias("_next"))
    base = F.when(F.col("_next") > 0, F.col("_next")).otherwise(F.col("base"))
    return firsts.join(known, TOPIC_PARTITION, "left").select(*TOPIC_PARTITION, base.alias("base"))


def rotate_by_count(
    accepted: DataFrame, flush_size: int, bases: DataFrame | None = None, is_stored: bool = False
) -> DataFrame:
    """Every ``flush_size`` records close a chunk.

    Strict acceptance leaves offsets without gaps, so this is arithmetic on the offset: no sort, no shuffle.
    ``is_stored`` says that ``bases`` is read from files already and need not be stored for the join.
    """
    start = chunk_bases(accepted) if bases is None else bases
    start = start if is_stored else stored(start)
    chunk = F.expr(f"(kafka_offset - base) div {int(flush_size)}")
    return accepted.join(start, TOPIC_PARTITION).withColumn("chunk", chunk).drop("base")


def rotate_ranked(accepted: DataFrame, flush_size: int, width: int = SLICE_WIDTH) -> DataFrame:
    """``rotate_by_count`` for offsets with gaps: counts records instead of subtracting offsets."""
    numbered = ranked(accepted, TOPIC_PARTITION, "kafka_offset", "_rank", width)
    return numbered.withColumn("chunk", F.expr(f"(_rank - 1) div {int(flush_size)}")).drop("_rank")


def batch_rotations(
    accepted: DataFrame,
    clock: str,
    flush_size: int = NO_LIMIT,
    interval_ms: int = -1,
    start_ms: int = 0,
    position: str = "kafka_offset",
) -> DataFrame:
    """What every delivered batch does to the open files of its topic-partition.

    A batch is the records of a topic-partition with the same ``clock`` (epoch milliseconds, ascending in order of
    delivery). Elapsed time is only looked at when a record is processed and the clock is read once per batch, so
    only the first record of a batch can close files by time. ``start_ms`` is when the last rotation took place
    before the first batch; 0 makes the first record rotate at once.

    Only one row per batch is folded, in one streaming pass that holds three numbers.
    """
    batches = accepted.groupBy(*TOPIC_PARTITION, clock).agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("first")
    )

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, open_records, last, chunks = None, 0, start_ms, 0
        for frame in frames:
            out = []
            columns = (frame[name].tolist() for name in [*TOPIC_PARTITION, clock, "n", "first"])
            for topic, partition, now, n, first in zip(*columns):
                if (topic, partition) != owner:
                    owner, open_records, last, chunks = (topic, partition), 0, start_ms, 0
                fired = 0 < interval_ms <= now - last
                carried = open_records
                if fired:
                    rotations = 1 + (n - 1) // flush_size
                    open_records = (n - 1) % flush_size
                else:
                    rotations = (open_records + n) // flush_size
                    open_records = (open_records + n) % flush_size
                out.append((topic, partition, now, first, fired, carried, chunks, rotations))
                chunks += rotations
                if rotations:
                    last = now
            yield pd.DataFrame(
                out, columns=[*TOPIC_PARTITION, clock, "first", "fired", "carried", "chunks", "rotations"]
            )

    return (
        batches.repartition(*TOPIC_PARTITION)
        .sortWithinPartitions(*TOPIC_PARTITION, clock)
        .mapInPandas(
            fold,
            f"topic string, kafka_partition int, {clock} bigint, first bigint, fired boolean, "
            "carried bigint, chunks bigint, rotations bigint",
        )
    )


def rotate(
    accepted: DataFrame,
    clock: str,
    flush_size: int = NO_LIMIT,
    interval_ms: int = -1,
    start_ms: int = 0,
    contiguous: bool = True,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Close a chunk by count or by elapsed time, whichever comes first; either resets both.

    ``contiguous`` states that offsets have no gaps, as after strict acceptance. Otherwise records are ranked first.
    """
    position = "kafka_offset"
    rows = accepted
    if not contiguous:
        position = "_rank"
        rows = ranked(accepted, TOPIC_PARTITION, "kafka_offset", position, width)
    folded = batch_rotations(rows, clock, flush_size, interval_ms, start_ms, position)
    # Place of the record in its batch, from 0.
    place = f"({position} - first)"
    chunk = F.expr(
        f"""chunks + case when not fired then (carried + {place}) div {flush_size}
                          when {place} = 0 then 0
                          else 1 + ({place} - 1) div {flush_size} end"""
    )
    return (
        rows.join(stored(folded), [*TOPIC_PARTITION, clock])
        .withColumn("chunk", chunk.cast("bigint"))
        .select(*accepted.columns, "chunk")
    )


def closed_chunks(folded: DataFrame) -> DataFrame:
    """Number of chunks closed so far per topic-partition, from ``batch_rotations``."""
    return folded.groupBy(*TOPIC_PARTITION).agg(
        F.max(F.col("chunks") + F.col("rotations")).alias("closed")
    )


def mark_complete(plan: DataFrame, flush_size: int) -> DataFrame:
    """Add ``complete``: whether the chunk of a planned file is full, all its directories together.

    Files of an unfilled chunk are not published; their records are read again after a restart.
    """
    chunk = Window.partitionBy(*TOPIC_PARTITION, "chunk")
    return plan.withColumn("complete", F.sum("n_records").over(chunk) >= flush_size)
