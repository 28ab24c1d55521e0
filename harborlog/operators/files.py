"""Plan files from routed records: what each file holds, where it goes and what it is called."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.functions.naming import committed_name, relative_directory
from harborlog.functions.partitioners import Partitioner
from harborlog.operators.rotation import mark_complete
from harborlog.sources.envelope import TOPIC_PARTITION

FILE_KEY = [*TOPIC_PARTITION, "encoded_partition", "chunk"]


def with_directory(records: DataFrame, partitioner: Partitioner) -> DataFrame:
    """Route each record: add ``encoded_partition``."""
    return records.withColumn("encoded_partition", partitioner(records))


def file_plan(
    chunked: DataFrame, flush_size: int, extension: str = ".parquet", pad_width: int = 10
) -> DataFrame:
    """One row per file: offset range, count, whether its chunk is complete, directory and name.

    Takes ``encoded_partition`` and ``chunk`` per record. Counts are aggregated on the map side, so a hot
    topic-partition or directory does not skew the shuffle.
    """
    ranges = chunked.groupBy(*FILE_KEY).agg(
        F.min("kafka_offset").alias("start_offset"),
        F.max("kafka_offset").alias("end_offset"),
        F.count(F.lit(1)).alias("n_records"),
    )
    name = committed_name(
        F.col("topic"),
        F.col("kafka_partition"),
        F.col("start_offset"),
        F.col("end_offset"),
        extension,
        pad_width,
    )
    return (
        mark_complete(ranges, flush_size)
        .withColumn("directory", relative_directory(F.col("topic"), F.col("encoded_partition")))
        .withColumn("committed_file", name)
    )


def files_with_max_offset(files: DataFrame) -> DataFrame:
    """The file with the greatest end offset per topic-partition; the lowest path wins a tie.

    Takes ``topic, kafka_partition, end_offset, path``.
    """
    rank = F.struct((-F.col("end_offset")).alias("descending"), F.col("path"))
    return files.groupBy(*TOPIC_PARTITION).agg(
        F.min_by("path", rank).alias("path"), F.max("end_offset").alias("end_offset")
    )


def file_order(chunked: DataFrame) -> DataFrame:
    """Bring the records of each file together in offset order, and number them from 1.

    A file holds at most ``flush_size`` records, which bounds both the sort and the window.
    """
    in_file = Window.partitionBy(*FILE_KEY).orderBy("kafka_offset")
    return chunked.withColumn("place", F.row_number().over(in_file).cast("bigint"))
