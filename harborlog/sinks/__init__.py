"""Sinks: output formats, and publishing staged files under their final names."""

from harborlog.sinks.claims import Claims, Fenced
from harborlog.sinks.direct import stray_files, write_committed
from harborlog.sinks.formats import FORMATS, OutputFormat, ParquetFormat, SequenceFormat, TableFormat, format_for
from harborlog.sinks.publish import Part, publish

__all__ = [
    "Claims",
    "FORMATS",
    "Fenced",
    "OutputFormat",
    "ParquetFormat",
    "Part",
    "SequenceFormat",
    "TableFormat",
    "format_for",
    "publish",
    "stray_files",
    "write_committed",
]
