"""Column functions: names and paths, partition tokens, binary keys. All run inside the JVM."""

from harborlog.functions.keys import raw_bytes, time_key
from harborlog.functions.naming import (
    committed_name,
    directory_path,
    has_end_offset,
    is_committed,
    is_temporary,
    joined_path,
    log_path,
    of_topic,
    of_topic_partition,
    parsed_name,
    relative_directory,
    temporary_name,
    topic_directory,
)
from harborlog.functions.partitioners import (
    by_field,
    by_kafka_partition,
    by_payload_field,
    by_time,
    partitioner_for,
)

__all__ = [
    "by_field",
    "by_kafka_partition",
    "by_payload_field",
    "by_time",
    "committed_name",
    "directory_path",
    "has_end_offset",
    "is_committed",
    "is_temporary",
    "joined_path",
    "log_path",
    "of_topic",
    "of_topic_partition",
    "parsed_name",
    "partitioner_for",
    "raw_bytes",
    "relative_directory",
    "temporary_name",
    "time_key",
    "topic_directory",
]
