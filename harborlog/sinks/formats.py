"""Output formats: write the rows of each planned file to one staged file.

A format has an ``extension`` and a method ``stage(rows, files, folder)``. ``rows`` carry ``file_id`` and
``kafka_offset`` beside the columns to be written, ``files`` has one row per ``file_id``, and the result tells the
``staged_path`` of each ``file_id``: the file, or a directory that holds just that file. Anything of this shape can be passed as a format. ``needs_value`` says whether the
format writes the message bytes rather than the decoded payload.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlog.functions.keys import time_key
from harborlog.sinks.staged import ParquetFile, SequenceFile, stage_files


class OutputFormat(Protocol):
    extension: str
    needs_value: bool

    def stage(self, rows: DataFrame, files: DataFrame, folder: str) -> DataFrame: ...


@dataclass(frozen=True)
class TableFormat:
    """Any format Spark can write. Decoded payload fields become the columns; without a payload, key and value do."""

    name: str
    extension: str
    options: dict[str, str] = field(default_factory=dict)
    needs_value: bool = False

    def stage(self, rows: DataFrame, files: DataFrame, folder: str) -> DataFrame:
        content = ["payload.*"] if "payload" in rows.columns else ["key", "value"]
        # All rows of a file meet in one task in offset order, and a file holds at most flush_size rows. A stated
        # number of partitions keeps adaptive execution from merging many small files into one writing task.
        spark = rows.sparkSession
        width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        ordered = rows.repartition(width, "file_id").sortWithinPartitions("file_id", "kafka_offset")
        (
            ordered.select("file_id", *content)
            .write.format(self.name)
            .options(**self.options)
            .partitionBy("file_id")
            .save(folder)
        )
        return files.select("file_id", F.concat(F.lit(f"{folder}/file_id="), F.col("file_id")).alias("staged_path"))


@dataclass(frozen=True)
class SequenceFormat:
    """Hadoop sequence files: an 8-byte big-endian clock as the key, the message as the value.

    ``clock`` is a column of epoch milliseconds; by default the clock of the query.
    """

    extension: str = ".seq"
    clock: Column | None = None
    needs_value: bool = True

    def stage(self, rows: DataFrame, files: DataFrame, folder: str) -> DataFrame:
        clock = self.clock if self.clock is not None else F.unix_millis(F.current_timestamp())
        return stage_files(rows, [time_key(clock).alias("_clock"), F.col("value")], folder, self.extension, SequenceFile)


@dataclass(frozen=True)
class ParquetFormat:
    """Parquet files with a fixed codec, row group size and page size, written one after another by the tasks that sort their rows."""

    extension: str = ".parquet"
    needs_value: bool = False

    def stage(self, rows: DataFrame, files: DataFrame, folder: str) -> DataFrame:
        content = ["payload.*"] if "payload" in rows.columns else ["key", "value"]
        return stage_files(rows, content, folder, self.extension, ParquetFile)


FORMATS: dict[str, OutputFormat] = {"parquet": ParquetFormat(), "sequence": SequenceFormat()}


def format_for(name: str | OutputFormat) -> OutputFormat:
    """Look up a format by name; anything else is taken as a format."""
    if not isinstance(name, str):
        return name
    if name not in FORMATS:
        raise ValueError(f"unknown format {name!r}; known are {sorted(FORMATS)}")
    return FORMATS[name]
