"""Positions: where each topic-partition continues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlog.plans import stored
from harborlog.sources.envelope import TOPIC_PARTITION


def committed_positions(manifest: DataFrame, assignment: DataFrame | None = None) -> DataFrame:
    """Greatest published end offset + 1 per topic-partition.

    With an ``assignment``, every topic-partition in it gets a row: -1 if nothing has been published.
    """
    ends = manifest.groupBy(*TOPIC_PARTITION).agg((F.max("end_offset") + 1).alias("next_offset"))
    if assignment is None:
        return ends
    return (
        assignment.select(*TOPIC_PARTITION)
        .join(ends, TOPIC_PARTITION, "left")
        .select(*TOPIC_PARTITION, F.coalesce("next_offset", F.lit(-1)).cast("bigint").alias("next_offset"))
    )


def resume(records: DataFrame, positions: DataFrame, is_stored: bool = False) -> DataFrame:
    """Leave out records below the position of their topic-partition.

    A position of 0 or less, or none, leaves nothing out. ``is_stored`` says that ``positions`` is read from files
    already and need not be stored for the join.
    """
    return _with_position(records, positions, is_stored).where(_open()).drop("_next")


def uncommitted_counts(records: DataFrame, positions: DataFrame) -> DataFrame:
    """Records not yet published per topic-partition, over all its directories."""
    return (
        _with_position(records.select(*TOPIC_PARTITION, "kafka_offset"), positions)
        .groupBy(*TOPIC_PARTITION)
        .agg(F.count(F.when(_open(), 1)).alias("n_uncommitted"))
    )


def _with_position(records: DataFrame, positions: DataFrame, is_stored: bool = False) -> DataFrame:
    known = positions.select(*TOPIC_PARTITION, F.col("next_offset").alias("_next"))
    return records.join(known if is_stored else stored(known), TOPIC_PARTITION, "left")


def _open():
    return F.col("_next").isNull() | (F.col("_next") <= 0) | (F.col("kafka_offset") >= F.col("_next"))
