"""Names and paths of published files.

A published file is called ``<topic>+<partition>+<first offset>+<last offset><extension>`` and lives under
``<base>/<topics dir>/<topic>/<encoded partition>/``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shape of a published name. The character before the extension is any character.
COMMITTED_PATTERN = r"^[a-zA-Z0-9._\-]+\+\d+\+\d+\+\d+(.\w+)?$"
NAME_PARTS_PATTERN = r"^([a-zA-Z0-9._\-]+)\+(\d+)\+(\d+)\+(\d+)(.\w+)?$"
SEPARATOR = "+"
TEMP_DIRECTORY = "+tmp"
TEMP_SUFFIX = "_tmp"
DEFAULT_PAD_WIDTH = 10


def committed_name(
    topic: Column,
    kafka_partition: Column,
    start_offset: Column,
    end_offset: Column,
    extension: str,
    pad_width: int = DEFAULT_PAD_WIDTH,
) -> Column:
    """Name of the file that holds ``start_offset`` to ``end_offset``.

    Offsets longer than the pad keep all their digits; width 0 means no padding.
    """
    if pad_width < 0:
        raise ValueError("pad_width must not be negative")
    offset = f"%0{pad_width}d" if pad_width else "%d"
    return F.format_string(
        f"%s+%d+{offset}+{offset}%s", topic, kafka_partition, start_offset, end_offset, F.lit(extension)
    )


def temporary_name(extension: str) -> Column:
    """A fresh name for a file in progress."""
    return F.concat(F.uuid(), F.lit(TEMP_SUFFIX + extension))


def parsed_name(file_name: Column) -> Column:
    """Struct of topic, kafka_partition, start_offset, end_offset, extension; null if not a published name.

    Matching from both ends keeps topics that contain dots whole.
    """

    def part(group: int) -> Column:
        return F.regexp_extract(file_name, NAME_PARTS_PATTERN, group)

    return F.when(
        is_committed(file_name),
        F.struct(
            part(1).alias("topic"),
            part(2).cast("int").alias("kafka_partition"),
            part(3).cast("bigint").alias("start_offset"),
            part(4).cast("bigint").alias("end_offset"),
            part(5).alias("extension"),
        ),
    )


def is_committed(file_name: Column) -> Column:
    """Whether a base name is that of a published file."""
    return file_name.rlike(COMMITTED_PATTERN)


def of_topic(file_name: Column, topic: str) -> Column:
    """Whether a base name is that of a published file of ``topic``."""
    return is_committed(file_name) & (F.regexp_extract(file_name, NAME_PARTS_PATTERN, 1) == topic)


def of_topic_partition(file_name: Column, topic: str, kafka_partition: int) -> Column:
    """Whether a base name is that of a published file of one topic-partition."""
    number = F.regexp_extract(file_name, NAME_PARTS_PATTERN, 2).try_cast("int")
    return of_topic(file_name, topic) & (number == kafka_partition)


def has_end_offset(file_name: Column, end_offset: int) -> Column:
    """Whether a base name is that of a published file ending at ``end_offset``."""
    number = F.regexp_extract(file_name, NAME_PARTS_PATTERN, 4).try_cast("bigint")
    return is_committed(file_name) & (number == end_offset)


def is_temporary(path: Column) -> Column:
    """Whether a path lies in the temp directory or carries a temp name."""
    in_temp_directory = path.contains(f"/{TEMP_DIRECTORY}/") | path.startswith(f"{TEMP_DIRECTORY}/")
    return in_temp_directory | path.rlike(rf"{TEMP_SUFFIX}(\.\w+)?$")


def relative_directory(topic: Column, encoded_partition: Column) -> Column:
    """``<topic>/<encoded partition>``"""
    return F.concat_ws("/", topic, encoded_partition)


def topic_directory(base: str, topics_dir: str, topic: Column) -> Column:
    """``<base>/<topics dir>/<topic>``"""
    return F.concat_ws("/", F.lit(base), F.lit(topics_dir), topic)


def directory_path(base: str, topics_dir: str, directory: Column) -> Column:
    """``<base>/<topics dir>/<directory>``"""
    return F.concat_ws("/", F.lit(base), F.lit(topics_dir), directory)


def joined_path(base: str, topics_dir: str, directory: Column, name: Column) -> Column:
    """``<base>/<topics dir>/<directory>/<name>``"""
    return F.concat_ws("/", F.lit(base), F.lit(topics_dir), directory, name)


def log_path(base: str, logs_dir: str, topic: Column, kafka_partition: Column) -> Column:
    """Where the commit log of a topic-partition lives: ``<base>/<logs dir>/<topic>/<partition>/log``"""
    return F.concat_ws(
        "/", F.lit(base), F.lit(logs_dir), topic, kafka_partition.cast("string"), F.lit("log")
    )
