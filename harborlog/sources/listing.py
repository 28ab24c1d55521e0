"""Directory listings as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.functions.naming import is_temporary, parsed_name

LISTING_SCHEMA = "path string, file_name string, length bigint, modification_time timestamp"


def list_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """All files below ``directory``: path, file_name, length, modification_time.

    File contents are not read. A missing directory is an empty listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(directory)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def committed_files(listing: DataFrame) -> DataFrame:
    """The published files of a listing, with what their names say; files in progress are left out."""
    return (
        listing.withColumn("_parsed", parsed_name(F.col("file_name")))
        .where(F.col("_parsed").isNotNull() & ~is_temporary(F.col("path")))
        .select(*listing.columns, "_parsed.*")
    )


def leaf_directories(listing: DataFrame) -> DataFrame:
    """Directories that hold files and no directories: ``directory``.

    Every leaf is returned, however deep. Empty directories do not show in a listing of files.
    """
    parents = listing.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory")).distinct()
    parts = F.split("directory", "/")
    ancestors = parents.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                lambda depth: F.array_join(F.slice(parts, 1, depth), "/"),
            )
        ).alias("directory")
    ).distinct()
    return parents.join(ancestors, "directory", "left_anti")
