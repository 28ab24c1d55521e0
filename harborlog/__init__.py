"""Land partitioned, offset-ordered record logs as directories of files, exactly once, on Spark."""

from harborlog.config import IngestConfig

__all__ = ["IngestConfig"]
