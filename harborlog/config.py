"""Settings of an ingest, one field per setting that has a meaning on Spark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class IngestConfig:
    """What to write, where, and when to cut a file.

    ``base_path`` and ``flush_size`` are required; the other defaults are those a user of such sinks expects.
    """

    base_path: str
    flush_size: int
    topics_dir: str = "topics"
    logs_dir: str = "logs"
    format: str = "parquet"
    rotate_interval_ms: int = -1
    partitioner: str | Callable[[DataFrame], Column] = "default"
    partition_field: str = ""
    partition_duration_ms: int = -1
    path_format: str = ""
    locale: str = ""
    timezone: str = ""
    zero_pad_width: int = 10
    acceptance: str = "strict"
    publish_tail: bool = True
    stream_id: str = "ingest"
    #: ``staged`` files are renamed when they are published; ``direct`` ones are written where they stay (Parquet only).
    publish: str = "staged"
    #: Merge the manifest's parts as they come, so that readers visit few folders however many batches there were.
    compact_manifest: bool = True

    #: Of two queries on one topic-partition, let the older one fail before it commits.
    claims: bool = True

    def __post_init__(self) -> None:
        if not self.base_path:
            raise ValueError("base_path is required")
        if self.flush_size < 1:
            raise ValueError("flush_size must be at least 1")
        if self.zero_pad_width < 0:
            raise ValueError("zero_pad_width must not be negative")
        if self.publish not in ("staged", "direct"):
            raise ValueError(f"unknown way to publish {self.publish!r}")
        if self.publish == "direct" and self.format != "parquet":
            raise ValueError("direct publishing writes Parquet files")
        if self.acceptance not in ("strict", "monotonic"):
            raise ValueError(f"unknown acceptance mode {self.acceptance!r}")

    @property
    def topics_root(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.topics_dir}"

    @property
    def manifest_root(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.logs_dir}/manifest"

    @property
    def claims_root(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.logs_dir}/claims"

    @property
    def clock_root(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.logs_dir}/clock"

    @property
    def staging_root(self) -> str:
        return f"{self.topics_root}/_staging"
