"""Positions kept batch by batch, so that a replayed batch starts from where it started the first time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.sinks import paths
from harborlog.sinks.publish import Part
from harborlog.sources.envelope import TOPIC_PARTITION

SCHEMA = "topic string, kafka_partition int, next_offset bigint, taken_offset bigint, rotated_ms bigint, n_dropped bigint"
KNOWN = ["next_offset", "taken_offset", "rotated_ms"]
POSITIONS = "positions"


@dataclass(frozen=True)
class Positions:
    """One small table per batch, with a row per topic-partition; growing logs and manifests are never read for it.

    It is committed with the batch's part of the table at ``root``, by the same rename: positions never run ahead of what
    is published, nor behind. ``next_offset`` follows the published files and counts for everyone. ``taken_offset`` also counts
    records that this stream holds back for its next batch. ``rotated_ms`` is when files were last closed. ``n_dropped`` tells
    how many delivered records at or beyond the position the batch did not accept: where it stays above 0, strict acceptance
    waits at a gap.
    """

    root: str
    stream_id: str

    def read(self, spark: SparkSession, before_batch: int | None = None) -> DataFrame:
        """Where each topic-partition continues: after earlier batches of this stream and what others have published."""
        tables = []
        for stream in paths.subdirectories(self.root):
            if not stream.startswith("stream_id="):
                continue
            stream_id = stream.removeprefix("stream_id=")
            own = stream_id == self.stream_id
            last = self._last(stream_id, before_batch if own else None)
            if last is not None:
                table = spark.read.schema(SCHEMA).parquet(last)
                if not own:
                    table = table.withColumns({"taken_offset": F.col("next_offset"), "rotated_ms": F.lit(None).cast("bigint")})
                tables.append(table.select(*TOPIC_PARTITION, *KNOWN))
        if not tables:
            return spark.createDataFrame([], SCHEMA).select(*TOPIC_PARTITION, *KNOWN)
        return tables[0] if len(tables) == 1 else _latest(reduce(DataFrame.unionByName, tables))

    def others(self) -> dict[str, str]:
        """Where the newest positions of other streams lie."""
        names = [name.removeprefix("stream_id=") for name in paths.subdirectories(self.root) if name.startswith("stream_id=")]
        found = {stream_id: self._last(stream_id, None) for stream_id in names if stream_id != self.stream_id}
        return {stream_id: path for stream_id, path in found.items() if path is not None}

    def overtaken(self, noted: dict[str, str], before: DataFrame, taking: DataFrame) -> bool:
        """Whether other streams have published more of the topic-partitions in ``taking`` since ``noted`` and ``before`` were read."""
        changed = [path for stream_id, path in self.others().items() if noted.get(stream_id) != path]
        if not changed:
            return False
        spark = before.sparkSession
        now = spark.read.schema(SCHEMA).parquet(*changed).select(*TOPIC_PARTITION, F.col("next_offset").alias("_now"))
        known = now.join(taking.select(*TOPIC_PARTITION), TOPIC_PARTITION, "left_semi").join(before, TOPIC_PARTITION, "left")
        return not known.where(F.col("_now") > F.coalesce("next_offset", F.lit(0))).isEmpty()

    def advance(self, part: Part, ends: DataFrame, before: DataFrame) -> None:
        """Attach the positions after a batch that ended at ``ends`` to its part; where it ended nowhere, ``before`` holds.

        ``ends`` may have ``next_offset`` alone: nothing is held back then.
        """
        if "taken_offset" not in ends.columns:
            ends = ends.withColumn("taken_offset", F.col("next_offset"))
        after = _latest(before.unionByName(ends, allowMissingColumns=True), "n_dropped")
        part.attach(POSITIONS, after.coalesce(1))

    def forget_before(self, batch_id: int) -> None:
        """Drop what no replay can need: all but the last table before ``batch_id``."""
        for number in [number for number in self._batches(self.stream_id) if number < batch_id][-2:-1]:
            for name in paths.subdirectories(Part(self.root, self.stream_id, number).path):
                paths.delete_directory(f"{Part(self.root, self.stream_id, number).path}/{name}")

    def last_before(self, batch_id: int) -> Part | None:
        """The stream's last batch before this one."""
        numbers = [number for number in self._batches(self.stream_id) if number < batch_id]
        parts = (Part(self.root, self.stream_id, number) for number in reversed(numbers))
        return next((part for part in parts if part.committed()), None)

    def _last(self, stream_id: str, before_batch: int | None) -> str | None:
        for number in reversed(self._batches(stream_id)):
            if before_batch is None or number < before_batch:
                found = Part(self.root, stream_id, number).attached(POSITIONS)
                if found is not None:
                    return found
        return None

    def _batches(self, stream_id: str) -> list[int]:
        return sorted(int(name.split("=", 1)[1]) for name in paths.subdirectories(f"{self.root}/stream_id={stream_id}"))


def _latest(tables: DataFrame, *more: str) -> DataFrame:
    columns = [*KNOWN, *more]
    tables = tables.withColumns({name: F.lit(None).cast("bigint") for name in columns if name not in tables.columns})
    return tables.groupBy(*TOPIC_PARTITION).agg(*(F.max(name).alias(name) for name in columns))
