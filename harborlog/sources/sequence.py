"""Published sequence files as rows, with where each comes from.

The files to read are rows themselves: listed or taken from the manifest by Spark, and opened in tasks, one after another. What is
no published name, lies in the temp directory or is not in the manifest is never opened. Records are read as a stream.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.functions.naming import parsed_name
from harborlog.sinks import paths
from harborlog.sources.listing import committed_files, list_files

PARTS = ["topic", "kafka_partition", "start_offset", "end_offset"]
PAIRS = "key binary, value binary, committed_file string, topic string, kafka_partition int, start_offset bigint, end_offset bigint"
#: Bytes of pairs that a task hands over at a time.
BATCH = 4 << 20

# The start of a sequence file, its version with a sync marker and named codec, and what announces a marker.
MAGIC = b"SEQ\x06"
SYNC = 16
SYNC_ESCAPE = -1
#: Values compressed one by one, as Hadoop does unless told otherwise.
CODECS = {"org.apache.hadoop.io.compress.DefaultCodec": zlib.MAX_WBITS, "org.apache.hadoop.io.compress.GzipCodec": zlib.MAX_WBITS | 16}
WRITABLE = "org.apache.hadoop.io.BytesWritable"


def read_sequence(
    spark: SparkSession, topics_root: str, manifest: DataFrame | None = None, topic: str | None = None, kafka_partition: int | None = None
) -> DataFrame:
    """Pairs of all published sequence files: ``key, value, committed_file, topic, kafka_partition, start_offset, end_offset``.

    With a ``manifest`` nothing is listed: its files are read, wherever they lie now below the root. Values may be plain or
    compressed record by record; block-compressed files and other codecs fail with their name, as do cut files.
    """
    root = topics_root.rstrip("/")
    if manifest is None:
        below = root if topic is None else f"{root}/{topic}"
        files = committed_files(list_files(spark, below, "*+*+*+*")).where("extension = '.seq'").select("path", F.col("file_name").alias("committed_file"), *PARTS)
    else:
        path = F.concat(F.lit(f"{root}/"), F.substring_index("path", f"/{root.rsplit('/', 1)[-1]}/", -1))
        named = manifest.withColumn("_parsed", parsed_name(F.col("committed_file"))).where("_parsed.extension = '.seq'")
        files = named.select(path.alias("path"), "committed_file", *PARTS)
    if topic is not None:
        files = files.where(F.col("topic") == topic)
    if kafka_partition is not None:
        files = files.where(F.col("kafka_partition") == kafka_partition)
    # A few files a task, whatever the files of the listing were grouped by.
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(width, "path").mapInArrow(_read, PAIRS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            filesystem, name = paths.resolve(file["path"])
            with filesystem.open_input_stream(name, buffer_size=1 << 20) as source:
                keys, values, held = [], [], 0
                for key, value in pairs(source, file["path"]):
                    keys.append(key)
                    values.append(value)
                    held += len(key) + len(value)
                    if held >= BATCH:
                        yield _rows(keys, values, file)
                        keys, values, held = [], [], 0
                if keys:
                    yield _rows(keys, values, file)


def _rows(keys: list[bytes], values: list[bytes], file: dict) -> pa.RecordBatch:
    kinds = {"committed_file": pa.string(), "topic": pa.string(), "kafka_partition": pa.int32(), "start_offset": pa.int64(), "end_offset": pa.int64()}
    columns = {"key": pa.array(keys, pa.binary()), "value": pa.array(values, pa.binary())}
    return pa.record_batch(columns | {name: pa.repeat(pa.scalar(file[name], kind), len(keys)) for name, kind in kinds.items()})


def pairs(source: BinaryIO, name: str) -> Iterator[tuple[bytes, bytes]]:
    """Keys and values of byte pairs in a sequence file."""

    def take(n: int) -> bytes:
        data = source.read(n)
        if len(data) < n:
            raise EOFError(f"{name} is cut")
        return data

    def number() -> int:
        return struct.unpack(">i", take(4))[0]

    def text() -> str:
        # A length of up to 127 is a byte; beyond, a negative byte tells how many bytes of the length follow.
        n = struct.unpack("b", take(1))[0]
        return take(n if n >= -112 else int.from_bytes(take(-112 - n), "big")).decode()

    if take(4) != MAGIC:
        raise ValueError(f"{name} is no sequence file of version 6")
    if (kinds := (text(), text())) != (WRITABLE, WRITABLE):
        raise ValueError(f"{name} holds {kinds}")
    compressed, in_blocks = take(1) != b"\0", take(1) != b"\0"
    codec = text() if compressed else None
    if in_blocks or (compressed and codec not in CODECS):
        raise ValueError(f"{name} is compressed by {codec}{' in blocks' if in_blocks else ''}")
    for _ in range(number()):
        text(), text()
    take(SYNC)
    while head := source.read(4):
        size = struct.unpack(">i", head + take(4 - len(head)))[0]
        if size == SYNC_ESCAPE:
            take(SYNC)
            continue
        key_size = number()
        key, value = take(key_size), take(size - key_size)
        if codec is not None:
            value = zlib.decompress(value, CODECS[codec])
        # Bytes come with their length in front.
        yield key[4:], value[4:]
