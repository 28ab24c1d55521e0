"""Read published files back, with where each row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.functions.naming import parsed_name
from harborlog.plans import stored
from harborlog.sources.listing import list_files

# Published names are the only ones with three separators; files in progress have none.
PUBLISHED_GLOB = "*+*+*+*"


def read_committed(
    spark: SparkSession,
    topics_root: str,
    schema: str | None = None,
    manifest: DataFrame | None = None,
    topic: str | None = None,
    kafka_partition: int | None = None,
) -> DataFrame:
    """Rows of all published Parquet files plus ``topic, kafka_partition, start_offset, end_offset``.

    Directory tokens need not be ``key=value``, so the tree is read as files rather than as a partitioned table. With
    a ``manifest``, only files it lists are trusted: the files beyond it, as a rule none, are found by comparing paths below
    the root, and rows are checked against those few rather than against the whole manifest.

    ``topic`` and ``kafka_partition`` narrow what is listed and read to the files of one topic or topic-partition.
    """
    if topic is not None:
        topics_root, below = f"{topics_root.rstrip('/')}/{topic}", topics_root
    else:
        below = topics_root
    glob = PUBLISHED_GLOB
    if topic is not None or kafka_partition is not None:
        part = "*" if kafka_partition is None else int(kafka_partition)
        glob = f"{'*' if topic is None else topic}+{part}+*+*"
    reader = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    )
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.parquet(topics_root)
    source = rows.withColumn("committed_file", F.col("_metadata.file_name"))
    if manifest is not None:
        # Listed after the rows, so no file that is read can be missing here.
        listed = list_files(spark, topics_root, glob).select(_below(F.col("path"), below).alias("_below"))
        trusted = manifest.select(_below(F.col("path"), below).alias("_below"))
        if topic is not None:
            trusted = manifest.where(F.col("topic") == topic).select(_below(F.col("path"), below).alias("_below"))
        beyond = stored(listed.join(trusted, "_below", "left_anti"))
        source = source.withColumn("_below", _below(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), below)).join(beyond, "_below", "left_anti")
    named = source.withColumn("_parsed", parsed_name(F.col("committed_file")))
    parts = ["topic", "kafka_partition", "start_offset", "end_offset"]
    return named.where(F.col("_parsed").isNotNull()).select(
        *rows.columns, "committed_file", *[F.col(f"_parsed.{part}").alias(part) for part in parts]
    )


def _below(path: Column, topics_root: str) -> Column:
    """A path below the topics root, whatever scheme and host stand before it."""
    root = topics_root.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(path, f"/{root}/", -1)
