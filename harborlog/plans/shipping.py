"""Make this package importable in Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once; the same as ``--py-files`` on submit."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix=package.name)}/{package.name}"
    context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
