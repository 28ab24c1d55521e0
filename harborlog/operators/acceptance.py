"""Drop stale and out-of-order records.

A position per topic-partition says which offset comes next. ``strict`` takes a record only if it carries exactly
that offset, so after a gap nothing more is taken until the missing offsets are delivered. ``monotonic`` takes any
record beyond the greatest offset seen so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.plans.bounded import Scratch, stored
from harborlog.plans.sliced import SLICE, SLICE_WIDTH, running_before, with_slice
from harborlog.sources.envelope import TOPIC_PARTITION

#: The place of a run in the order of arrival: its slice, and its number there in the lower bits.
RUN_BITS = 20
BUCKET = "_bucket"
PIECE = f"topic string, kafka_partition int, {BUCKET} bigint, at bigint, leaves bigint, starts boolean"
ENTRY = f"topic string, kafka_partition int, {BUCKET} bigint, entered bigint"
TAKEN = "topic string, kafka_partition int, at bigint, accept_from bigint"


def accept_monotonic(
    records: DataFrame,
    positions: DataFrame | None = None,
    arrival: str = "arrival_seq",
    width: int = SLICE_WIDTH,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Keep records whose offset lies beyond everything delivered before them.

    ``arrival`` orders the deliveries of a topic-partition and is unique in it. ``positions`` holds
    ``next_offset`` per topic-partition; without a row, or with -1, the first record sets the position.
    """
    seen = running_before(
        records, TOPIC_PARTITION, arrival, "kafka_offset", "_seen", width
    )
    fresh = F.col("_seen").isNull() | (F.col("kafka_offset") > F.col("_seen"))
    if positions is not None:
        known = positions.select(*TOPIC_PARTITION, F.col("next_offset").alias("_next"))
        seen = seen.join(known, TOPIC_PARTITION, "left")
        fresh = fresh & (F.col("_next").isNull() | (F.col("kafka_offset") >= F.col("_next")))
    return seen.where(fresh).select(*records.columns)


def accept_strict(
    records: DataFrame,
    positions: DataFrame | None = None,
    arrival: str = "arrival_seq",
    width: int = SLICE_WIDTH,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Keep records that carry exactly the next expected offset, in order of arrival.

    Deliveries are cut into slices, and slices into runs of consecutive offsets. The walk over the runs of a
    topic-partition is then split by offset, into buckets of ``width`` offsets. An expected position only grows, and
    runs are clipped to buckets, so a bucket is always entered at its first offset; all that is open is when. Every
    bucket works out on its own at which run it is left, for each run it may be entered with: only runs that hold its
    first offset, so a row per bucket and delivery of that offset. One streaming pass over these rows, with two
    numbers per topic-partition, tells when each bucket is entered. Buckets and rows are then settled in parallel.

    No task holds more than ``width`` numbers, whatever is missing from the log and however it alternates.
    ``scratch`` owns the table of runs.
    """
    if not 0 < width <= 1 << RUN_BITS:
        raise ValueError(f"width must be 1 to {1 << RUN_BITS}")
    in_order = Window.partitionBy(*TOPIC_PARTITION, SLICE).orderBy(arrival)
    continues = F.col("kafka_offset") == F.lag("kafka_offset").over(in_order) + 1
    run = F.sum("_break").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (
        with_slice(records, arrival, width)
        .withColumn("_break", F.when(continues, 0).otherwise(1))
        .withColumn("_run", run.cast("int"))
    )
    at = F.shiftleft(SLICE, RUN_BITS) + F.col("_run") - 1
    spans = numbered.groupBy(*TOPIC_PARTITION, SLICE, "_run").agg(
        F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high")
    )
    # A run that repeats the one just before it can't move any position.
    in_slice = Window.partitionBy(*TOPIC_PARTITION, SLICE).orderBy("_run")
    again = (F.lag("low").over(in_slice) <= F.col("low")) & (F.lag("high").over(in_slice) == F.col("high"))
    spans = spans.withColumn("_again", F.coalesce(again, F.lit(False))).where("not _again")
    # Needed several times below and far smaller than the records, so written once.
    runs = stored(spans.select(*TOPIC_PARTITION, at.alias("at"), "low", "high"), scratch=scratch)

    first = runs.groupBy(*TOPIC_PARTITION).agg(F.min_by("low", "at").alias("start"))
    if positions is not None:
        known = positions.select(*TOPIC_PARTITION, F.col("next_offset").alias("_known"))
        start = F.when(F.col("_known") >= 0, F.col("_known")).otherwise(F.col("start"))
        first = first.join(known, TOPIC_PARTITION, "left").withColumn("start", start)
    ahead = runs.join(first.select(*TOPIC_PARTITION, "start"), TOPIC_PARTITION).where("high >= start")
    buckets = F.sequence(F.expr(f"greatest(low, start) div {width}"), F.expr(f"high div {width}"))
    clipped = ahead.withColumn(BUCKET, F.explode(buckets)).select(
        *TOPIC_PARTITION,
        BUCKET,
        "at",
        F.expr(f"cast(greatest(low, start, {BUCKET} * {width}) - {BUCKET} * {width} as int)").alias("low"),
        F.expr(f"cast(least(high, {BUCKET} * {width} + {width} - 1) - {BUCKET} * {width} as int)").alias("high"),
        F.expr(f"cast(greatest(start - {BUCKET} * {width}, 0) as int)").alias("edge"),
        F.expr(f"{BUCKET} = start div {width}").alias("starts"),
    )
    dealt = clipped.repartition(*TOPIC_PARTITION, BUCKET)

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _leave_buckets(batches, width)

    pieces = dealt.sortWithinPartitions(*TOPIC_PARTITION, BUCKET, F.desc("at")).mapInPandas(leave, PIECE)
    entered = (
        pieces.repartition(*TOPIC_PARTITION)
        .sortWithinPartitions(*TOPIC_PARTITION, BUCKET, "at")
        .mapInPandas(_enter_buckets, ENTRY)
    )
    walked = dealt.join(entered, [*TOPIC_PARTITION, BUCKET]).where("at >= entered")
    taken = walked.repartition(*TOPIC_PARTITION, BUCKET).sortWithinPartitions(*TOPIC_PARTITION, BUCKET, "at")
    taken = taken.select(*TOPIC_PARTITION, BUCKET, "at", "low", "high", "edge", "starts").mapInPandas(_take_runs(width), TAKEN)

    # One row per slice, with the accepted start of each of its runs, keeps the rows on the partitioning they
    # already have: (topic, kafka_partition, slice).
    number = F.col("at").bitwiseAND(F.lit((1 << RUN_BITS) - 1)).cast("int")
    runs_taken = taken.groupBy(*TOPIC_PARTITION, F.shiftright("at", RUN_BITS).alias(SLICE), number.alias("_number")).agg(
        F.min("accept_from").alias("accept_from")
    )
    settled = runs_taken.groupBy(*TOPIC_PARTITION, SLICE).agg(
        F.map_from_entries(F.collect_list(F.struct("_number", "accept_from"))).alias("accept_from")
    )
    accept_from = F.try_element_at("accept_from", F.col("_run") - 1)
    return (
        numbered.join(settled, [*TOPIC_PARTITION, SLICE])
        .where(F.col("kafka_offset") >= accept_from)
        .select(*records.columns)
    )


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, bool, list[tuple]]]:
    """Runs of a bucket, batch by batch: the bucket, whether it has just begun, and its runs in the order given."""
    owner = None
    for batch in batches:
        keys = [batch[name].to_numpy() for name in [*TOPIC_PARTITION, BUCKET]]
        new = np.ones(len(batch), bool)
        new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
        cuts = np.flatnonzero(new)
        runs = list(zip(*(batch[name].tolist() for name in ("at", "low", "high", "edge", "starts"))))
        for low, high in zip(cuts, [*cuts[1:], len(batch)]):
            bucket = (keys[0][low], int(keys[1][low]), int(keys[2][low]))
            yield bucket, bucket != owner, runs[low:high]
            owner = bucket


def _leave_buckets(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """From each bucket's last run to its first: with which run it is left (-1: never), if entered with the run at hand."""
    leaves = np.full(width + 1, -1, np.int64)
    out: list[tuple] = []
    for bucket, begins, runs in _stretches(batches):
        if begins:
            leaves[:] = -1
        for at, low, high, edge, starts in runs:
            value = at if high + 1 == width else int(leaves[high + 1])
            leaves[low : high + 1] = value
            # Entered earlier with the same outcome: the later row speaks for both.
            if low == edge and not (out and out[-1][:3] == bucket and out[-1][4] == value):
                out.append((*bucket, at, value, starts))
        if len(out) > 1 << 16:
            yield pd.DataFrame(out[:-1], columns=[*TOPIC_PARTITION, BUCKET, "at", "leaves", "starts"])
            out = out[-1:]
    yield pd.DataFrame(out, columns=[*TOPIC_PARTITION, BUCKET, "at", "leaves", "starts"])


def _enter_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    owner, bucket, time = None, 0, -1
    for batch in batches:
        out = []
        names = [*TOPIC_PARTITION, BUCKET, "at", "leaves", "starts"]
        for topic, partition, number, at, leaves, starts in zip(*(batch[name].tolist() for name in names)):
            if (topic, partition) != owner:
                # Unless a run holds the start, nothing is ever accepted.
                owner, bucket, time = (topic, partition), number if starts else -1, -1
                if starts:
                    out.append((topic, partition, number, time))
            if number == bucket and at >= time:
                if leaves >= 0:
                    bucket, time = number + 1, leaves
                    out.append((topic, partition, bucket, time))
                else:
                    bucket = -1
        yield pd.DataFrame(out, columns=[*TOPIC_PARTITION, BUCKET, "entered"])


def _take_runs(width: int):
    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expected, out = -1, []
        for bucket, begins, runs in _stretches(batches):
            if begins:
                expected = runs[0][3]
            for at, low, high, *_ in runs:
                if low <= expected <= high:
                    out.append((*bucket[:2], at, bucket[2] * width + expected))
                    expected = high + 1
            if len(out) > 1 << 16:
                yield pd.DataFrame(out, columns=[*TOPIC_PARTITION, "at", "accept_from"])
                out = []
        yield pd.DataFrame(out, columns=[*TOPIC_PARTITION, "at", "accept_from"])

    return take
