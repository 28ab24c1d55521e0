"""Sources: topic logs, directories of published files, the manifest."""

from harborlog.sources.committed import read_committed
from harborlog.sources.envelope import (
    ENVELOPE,
    TOPIC_PARTITION,
    from_log_source,
    read_topics,
    route_counts,
    stream_topics,
)
from harborlog.sources.follow import follow_committed
from harborlog.sources.listing import committed_files, leaf_directories, list_files
from harborlog.sources.manifest import MANIFEST_SCHEMA, compact_manifest, read_manifest, rebuild_manifest
from harborlog.sources.sequence import read_sequence

__all__ = [
    "ENVELOPE",
    "MANIFEST_SCHEMA",
    "TOPIC_PARTITION",
    "committed_files",
    "compact_manifest",
    "follow_committed",
    "from_log_source",
    "leaf_directories",
    "list_files",
    "read_committed",
    "read_manifest",
    "read_sequence",
    "read_topics",
    "rebuild_manifest",
    "route_counts",
    "stream_topics",
]
