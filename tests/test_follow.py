"""Following published files over restarts, bounds, compaction and both ways to publish."""

import pytest
from pyspark.sql.types import StructType
from test_ingest import config, expect, log

from harborlog.sources import compact_manifest, follow_committed, read_manifest
from harborlog.sources.follow import OPENING, PROVENANCE, TASK_ROWS, _Reader, _tasks
from harborlog.streaming import ingest_batch
from workload.fixtures import message

COLUMNS = "event_id bigint, absent double"


def follow(spark, conf, tmp_path, **settings):
    rows = follow_committed(spark, conf.manifest_root, COLUMNS, **settings)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True)
    query = writer.start(str(tmp_path / "followed"))
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(tmp_path / "followed")).collect()


def seen(rows):
    return sorted((row.kafka_partition, row.event_id % 1_000_000) for row in rows)


@pytest.mark.parametrize("way", ["staged", "direct"])
def test_each_file_once_over_restarts_and_compaction(spark, tmp_path, way):
    conf = config(tmp_path, publish=way, compact_manifest=False)
    progress = str(tmp_path / "progress")
    for batch_id in range(5):
        ingest_batch(log(spark, {0: (10 * batch_id, 10 * batch_id + 10)}), batch_id, conf, message())
    assert seen(follow(spark, conf, tmp_path, batches_per_trigger=2, progress=progress)) == expect({0: (0, 20)})
    # The follower stands in the middle of what is merged.
    assert compact_manifest(spark, conf.manifest_root, conf.stream_id, fan_in=3)
    assert seen(follow(spark, conf, tmp_path, batches_per_trigger=2, progress=progress)) == expect({0: (0, 40)})
    ingest_batch(log(spark, {0: (50, 57), 1: (0, 3)}), 5, conf, message())
    rows = follow(spark, conf, tmp_path)
    assert seen(rows) == expect({0: (0, 57), 1: (0, 3)})
    assert seen(follow(spark, conf, tmp_path)) == seen(rows)
    assert {row.absent for row in rows} == {None} and {row.topic for row in rows} == {"t"}
    listed = {(r.committed_file, r.start_offset, r.end_offset) for r in read_manifest(spark, conf.manifest_root).collect()}
    assert {(r.committed_file, r.start_offset, r.end_offset) for r in rows} == listed


def test_topics_and_what_is_not_committed(spark, tmp_path):
    conf = config(tmp_path)

    def crash(at):
        if at == "recorded":
            raise InterruptedError(at)

    ingest_batch(log(spark, {0: (0, 4)}, "t").unionByName(log(spark, {0: (0, 6)}, "u")), 0, conf, message())
    with pytest.raises(InterruptedError):
        ingest_batch(log(spark, {0: (4, 9)}, "t"), 1, conf, message(), on_step=crash)
    assert seen(follow(spark, conf, tmp_path, topic="t")) == expect({0: (0, 4)})
    ingest_batch(log(spark, {0: (4, 9)}, "t"), 1, conf, message())
    assert seen(follow(spark, conf, tmp_path, topic="t")) == expect({0: (0, 9)})


def test_a_task_reads_many_files(spark, tmp_path):
    conf = config(tmp_path)
    ingest_batch(log(spark, {0: (0, 200), 1: (0, 200)}), 0, conf, message())
    reader = _Reader({"manifest_root": conf.manifest_root}, StructType.fromDDL(f"{COLUMNS}, {PROVENANCE}"))
    tasks = reader.partitions({}, reader.latestOffset())
    assert len(tasks) == 1 and len(tasks[0].value) == read_manifest(spark, conf.manifest_root).count() > 20
    assert seen(follow(spark, conf, tmp_path)) == expect({0: (0, 200), 1: (0, 200)})


def test_tasks_are_bounded():
    files = [(n, (i,)) for i, n in enumerate([0, 5, TASK_ROWS, TASK_ROWS // 2, 7] + [100] * 1000)]
    tasks = list(_tasks(files))
    assert [file for task in tasks for file in task] == [file for _, file in files]
    assert all(len(task) == 1 or sum(files[i][0] + OPENING for (i,) in task) <= TASK_ROWS for task in tasks)
