"""Acceptance of a stream that may redeliver.

``start_accept`` works batch by batch with the table operators, which split a hot topic-partition over many tasks.
``stream_accept`` is an operator to put into a larger streaming query; its state is one number per topic-partition.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from harborlog.operators.acceptance import accept_monotonic, accept_strict
from harborlog.plans import Scratch, bounded
from harborlog.sinks.publish import Part
from harborlog.sources.envelope import TOPIC_PARTITION
from harborlog.streaming.positions import Positions


class _Acceptor(StatefulProcessor):
    """The position of a topic-partition, and a buffer for the rows of a micro-batch that come in several pieces.

    Pieces come in any order, so what is accepted is known after the last one. Until then their rows are kept in the state
    store, which is on disk, and memory holds two numbers per row.
    """

    def __init__(self, columns: list[str], arrival: str, strict: bool) -> None:
        self.columns, self.arrival, self.strict = columns, arrival, strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.position = handle.getValueState("position", "expected bigint")
        self.buffer = handle.getListState("buffer", "piece binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        first, second = next(rows), next(rows, None)
        if second is None:
            (keep,) = self._accepted([first[[self.arrival, "kafka_offset"]].to_numpy(np.int64)])
            yield first.sort_values(self.arrival)[self.columns] if keep.all() else first[keep].sort_values(self.arrival)[self.columns]
            return
        seen = []
        for piece in chain((first, second), rows):
            seen.append(piece[[self.arrival, "kafka_offset"]].to_numpy(np.int64))
            self.buffer.appendValue((pickle.dumps(piece[self.columns], protocol=pickle.HIGHEST_PROTOCOL),))
        del first, second, piece
        for keep, (data,) in zip(self._accepted(seen), self.buffer.get()):
            if keep.any():
                yield pickle.loads(bytes(data))[keep]
        self.buffer.clear()

    def _accepted(self, pieces: list[np.ndarray]) -> list[np.ndarray]:
        """Which rows of each piece are accepted; moves the position."""
        seen = np.concatenate(pieces)
        order = np.argsort(seen[:, 0], kind="stable")
        offsets = seen[order, 1]
        expected = int(self.position.get()[0]) if self.position.exists() else int(offsets[0])
        in_order, expected = (_strict if self.strict else _monotonic)(offsets, expected)
        self.position.update((expected,))
        keep = np.zeros(len(offsets), bool)
        keep[order] = in_order
        return np.split(keep, np.cumsum([len(piece) for piece in pieces])[:-1])

    def close(self) -> None:
        pass


def stream_accept(
    stream: DataFrame, arrival: str = "arrival_seq", mode: str = "strict"
) -> DataFrame:
    """Drop stale and out-of-order records of a stream; see ``accept_strict`` and ``accept_monotonic``.

    Micro-batches must deliver in order of ``arrival``. The records of a topic-partition in one micro-batch go through one task,
    which holds two numbers for each, and the records themselves in the state store; bound micro-batches by the rate limit of the
    source. Needs the RocksDB state store.
    """
    # Spark starts the processor once on the driver, in a process that does not see added Python files.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return stream.groupBy(*TOPIC_PARTITION).transformWithStateInPandas(
        statefulProcessor=_Acceptor(stream.columns, arrival, mode == "strict"),
        outputStructType=stream.schema,
        outputMode="append",
        timeMode="none",
    )


def start_accept(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    arrival: str = "arrival_seq",
    mode: str = "strict",
    stream_id: str = "accept",
    **trigger,
) -> StreamingQuery:
    """Write the accepted records of each micro-batch to ``folder/accepted``, exactly once.

    The positions are committed with the records. A micro-batch that is replayed after that has nothing left to do; one that
    failed before starts from the same positions.
    """
    accept = accept_strict if mode == "strict" else accept_monotonic
    root = f"{folder}/accepted"
    positions = Positions(root, stream_id)

    def each(batch: DataFrame, batch_id: int) -> None:
        part = Part(root, stream_id, batch_id)
        if part.committed():
            return
        with Scratch(batch.sparkSession, "accept") as scratch:
            before = bounded(positions.read(batch.sparkSession, batch_id))
            part.write(accept(batch, before, arrival, scratch=scratch))
            written = batch.sparkSession.read.schema(batch.schema).parquet(part.written)
            ends = written.groupBy(*TOPIC_PARTITION).agg((F.max("kafka_offset") + 1).alias("next_offset"))
            positions.advance(part, ends, before)
            part.commit()
            positions.forget_before(batch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _strict(offsets: np.ndarray, expected: int) -> tuple[np.ndarray, int]:
    keep = np.zeros(len(offsets), dtype=bool)
    breaks = np.flatnonzero(np.diff(offsets) != 1) + 1
    for start, stop in zip(np.r_[0, breaks], np.r_[breaks, len(offsets)]):
        low, high = int(offsets[start]), int(offsets[stop - 1])
        if low <= expected <= high:
            keep[start + expected - low : stop] = True
            expected = high + 1
    return keep, expected


def _monotonic(offsets: np.ndarray, expected: int) -> tuple[np.ndarray, int]:
    before = np.maximum.accumulate(np.r_[expected - 1, offsets[:-1]])
    return offsets > before, max(expected, int(offsets.max()) + 1)
