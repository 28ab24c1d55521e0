"""Table operators: each takes DataFrames and returns a DataFrame."""

from harborlog.operators.acceptance import accept_monotonic, accept_strict
from harborlog.operators.commitlog import commit_log, publish_pending, replay
from harborlog.operators.files import FILE_KEY, file_order, file_plan, files_with_max_offset, with_directory
from harborlog.operators.payload import (
    FAILFAST,
    PERMISSIVE,
    MessageType,
    dead_letters,
    decode,
    decoded,
    encode,
    reencode,
)
from harborlog.operators.positions import committed_positions, resume, uncommitted_counts
from harborlog.operators.rotation import (
    chunk_bases,
    closed_chunks,
    mark_complete,
    rotate,
    rotate_by_count,
    rotate_ranked,
)

__all__ = [
    "FAILFAST",
    "FILE_KEY",
    "PERMISSIVE",
    "MessageType",
    "accept_monotonic",
    "accept_strict",
    "chunk_bases",
    "closed_chunks",
    "commit_log",
    "committed_positions",
    "dead_letters",
    "decode",
    "decoded",
    "encode",
    "file_order",
    "file_plan",
    "files_with_max_offset",
    "mark_complete",
    "publish_pending",
    "reencode",
    "replay",
    "resume",
    "rotate",
    "rotate_by_count",
    "rotate_ranked",
    "uncommitted_counts",
    "with_directory",
]
