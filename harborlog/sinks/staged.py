"""Staged files that tasks write themselves: a task opens one file after another, so many small ones cost no task each."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlog.plans import stored
from harborlog.sinks import paths

FILE = "__file_id"
#: Bytes of a row group and of a page of published Parquet files.
ROW_GROUP = 256 << 20
PAGE = 64 << 10
#: Bytes between two sync markers of a sequence file, and those it collects before it writes.
SYNC_EVERY = 100 << 10
BUFFER = 1 << 20

WRITABLE = b"org.apache.hadoop.io.BytesWritable"


class StagedFile(Protocol):
    def __init__(self, path: str, schema: pa.Schema) -> None: ...

    def add(self, rows: pa.RecordBatch) -> None: ...

    def close(self) -> None: ...


def stage_files(rows: DataFrame, content: list[str | Column], folder: str, extension: str, opened: Callable[[str, pa.Schema], StagedFile]) -> DataFrame:
    """Write the rows of each ``file_id`` to one file below ``folder``, in order of offset: ``file_id, staged_path``.

    Each attempt of a task writes to a folder of its own, and only attempts that end well are in the result.
    """
    # All rows of a file meet in one task in offset order, and a file holds at most flush_size rows. A stated
    # number of partitions keeps adaptive execution from merging many small files into one writing task.
    spark = rows.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = rows.repartition(width, "file_id").sortWithinPartitions("file_id", "kafka_offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, written, file = f"{folder}/{uuid.uuid4().hex}", {}, None
        for batch in batches:
            runs, body, low = pc.run_end_encode(batch.column(0)), batch.select(range(1, batch.num_columns)), 0
            for file_id, high in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if file_id not in written:
                    if file is None:
                        paths.make_directory(attempt)
                    else:
                        file.close()
                    written[file_id] = f"{attempt}/{file_id}{extension}"
                    file = opened(written[file_id], body.schema)
                file.add(body.slice(low, high - low))
                low = high
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array(written.keys(), pa.string()), pa.array(written.values(), pa.string())], names=["file_id", "staged_path"])

    picked = ordered.select(F.col("file_id").alias(FILE), *content)
    return stored(picked.mapInArrow(write, "file_id string, staged_path string"), f"{folder}/written")


class ParquetFile:
    """Snappy, row groups of 256 MiB, pages of 64 KiB."""

    def __init__(self, path: str, schema: pa.Schema) -> None:
        filesystem, name = paths.resolve(path)
        self.out = pq.ParquetWriter(name, schema, filesystem=filesystem, compression="snappy", data_page_size=PAGE)
        self.held: list[pa.RecordBatch] = []
        self.bytes = 0

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.bytes += rows.nbytes
        if self.bytes >= ROW_GROUP:
            self._flush()

    def _flush(self) -> None:
        self.out.write_table(pa.Table.from_batches(self.held), row_group_size=1 << 30)
        self.held, self.bytes = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        self.out.close()


class SequenceFile:
    """Plain pairs of bytes, from a batch's first column and its second."""

    def __init__(self, path: str, schema: pa.Schema) -> None:
        filesystem, name = paths.resolve(path)
        self.out, self.sync = filesystem.open_output_stream(name), os.urandom(16)
        kind = bytes([len(WRITABLE)]) + WRITABLE
        # Version, classes of keys and values, neither compressed nor in blocks, no metadata.
        self.held = bytearray(b"SEQ\x06" + kind + kind + bytes(6) + self.sync)
        self.since = 0

    def add(self, rows: pa.RecordBatch) -> None:
        for key, value in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            if value is None:
                raise ValueError("a sequence file takes no null value")
            if self.since >= SYNC_EVERY:
                self.held += struct.pack(">i", -1) + self.sync
                self.since = 0
            # Bytes come with their length in front, within a record that tells its length and its key's.
            self.held += struct.pack(">iii", len(key) + len(value) + 8, len(key) + 4, len(key)) + key + struct.pack(">i", len(value)) + value
            self.since += len(key) + len(value) + 16
            if len(self.held) >= BUFFER:
                self._flush()

    def _flush(self) -> None:
        self.out.write(self.held)
        self.held = bytearray()

    def close(self) -> None:
        self._flush()
        self.out.close()
