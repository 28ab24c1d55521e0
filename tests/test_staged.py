"""Staging many small files: few tasks, one file each id, rows in order of offset."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from harborlog.sinks import SequenceFormat, format_for

FILES, ROWS = 300, 7


def staged(spark, output, folder):
    rows = spark.range(FILES * ROWS).select(
        F.md5(F.expr(f"cast(id % {FILES} as string)")).alias("file_id"), F.col("id").alias("kafka_offset"),
        F.encode(F.lit("k"), "utf-8").alias("key"), F.expr("cast(cast(id as string) as binary)").alias("value"),
    )
    context = spark.sparkContext
    context.setJobGroup(folder, "staging")
    try:
        found = output.stage(rows.repartition(5), rows.select("file_id").distinct(), folder).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(folder)]
    stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    assert max(stage.numTasks for stage in stages if stage is not None) <= context.defaultParallelism
    assert len(found) == len({row.file_id for row in found}) == FILES
    return {row.file_id: row.staged_path for row in found}


@pytest.fixture(scope="module")
def ids(spark):
    rows = spark.range(FILES).select("id", F.md5(F.col("id").cast("string")).alias("file_id")).collect()
    return {row.file_id: row.id for row in rows}


def test_sequence_files_take_few_tasks(spark, tmp_path, ids):
    found = staged(spark, SequenceFormat(clock=F.col("kafka_offset")), str(tmp_path / "s"))
    for file_id, path in sorted(found.items())[::100]:
        pairs = spark.sparkContext.sequenceFile(path).collect()
        whole = list(range(ids[file_id], FILES * ROWS, FILES))
        assert [int.from_bytes(key, "big") for key, _ in pairs] == whole and [int(bytes(value)) for _, value in pairs] == whole


def test_sequence_files_have_sync_markers(spark, tmp_path):
    rows = spark.range(3000).select(F.lit("f").alias("file_id"), F.col("id").alias("kafka_offset"), F.expr("cast(repeat('x', 200) as binary)").alias("value"))
    (row,) = SequenceFormat(clock=F.col("kafka_offset")).stage(rows, rows.select("file_id").distinct(), str(tmp_path / "s")).collect()
    # Hadoop's own reader finds its way by the markers when a file is read in splits.
    pairs = spark.sparkContext.sequenceFile(row.staged_path, minSplits=5)
    assert pairs.getNumPartitions() >= 5 and sorted(int.from_bytes(key, "big") for key in pairs.keys().collect()) == list(range(3000))


def test_parquet_files_are_written_by_the_tasks_that_sort(spark, tmp_path, ids):
    folder = str(tmp_path / "p")
    found = staged(spark, format_for("parquet"), folder)
    assert all(os.path.isfile(path) for path in found.values()) and not glob.glob(f"{folder}/file_id=*")
    for file_id, path in found.items():
        assert [int(value) for value in pq.read_table(path, columns=["value"])["value"].to_pylist()] == list(range(ids[file_id], FILES * ROWS, FILES))
    first = pq.ParquetFile(next(iter(found.values())))
    assert first.schema_arrow.names == ["key", "value"] and first.metadata.row_group(0).column(0).compression == "SNAPPY"
    read = spark.read.parquet(*list(found.values())[:10])
    assert [field.dataType.simpleString() for field in read.schema] == ["binary", "binary"] and read.count() == 10 * ROWS
