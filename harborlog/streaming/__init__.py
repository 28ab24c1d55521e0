"""Streaming: exactly-once ingest, and acceptance of streams that may redeliver."""

from harborlog.streaming.accept import start_accept, stream_accept
from harborlog.streaming.ingest import ingest_batch, start_ingest
from harborlog.streaming.positions import Positions

__all__ = ["Positions", "ingest_batch", "start_accept", "start_ingest", "stream_accept"]
