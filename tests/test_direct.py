"""Publishing in place, and the merged manifest."""

import glob
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_ingest import config, expect, log, offsets

from harborlog.sinks import paths, stray_files
from harborlog.sources import compact_manifest, read_committed, read_manifest, rebuild_manifest
from harborlog.sources import manifest as M
from harborlog.streaming import ingest_batch
from workload.fixtures import message


def files_below(root):
    return [path for path in glob.glob(f"{root}/**", recursive=True) if os.path.isfile(path) and path.endswith(".parquet")]


@pytest.mark.parametrize("tail", [True, False])
def test_batches_replays_and_crashes_without_a_rename(spark, tmp_path, monkeypatch, tail):
    monkeypatch.setattr(paths, "move", None)
    conf = config(tmp_path, publish="direct", partitioner="protocol", publish_tail=tail)

    def crash(at):
        if at == "recorded":
            raise InterruptedError(at)

    for batch_id, ranges in enumerate([{0: (0, 25), 1: (0, 7)}, {0: (20, 48), 1: (7, 31)}]):
        with pytest.raises(InterruptedError):
            ingest_batch(log(spark, ranges), batch_id, conf, message(), on_step=crash)
        for _ in range(2):
            ingest_batch(log(spark, ranges), batch_id, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 48), 1: (0, 31)} if tail else {0: (0, 40), 1: (0, 30)})
    manifest = read_manifest(spark, conf.manifest_root)
    assert len(files_below(conf.topics_root)) == manifest.count()
    rebuilt = {tuple(row) for row in rebuild_manifest(spark, conf.topics_root).select("topic", "encoded_partition", "start_offset", "end_offset").collect()}
    assert rebuilt == {tuple(row) for row in manifest.select("topic", "encoded_partition", "start_offset", "end_offset").collect()}
    for path in files_below(conf.topics_root):
        read = pq.ParquetFile(path)
        assert read.metadata.row_group(0).column(0).compression == "SNAPPY"
        assert read.read(["event_id"])["event_id"].to_pylist() == sorted(read.read(["event_id"])["event_id"].to_pylist())


def test_new_checkpoint_after_a_crash(spark, tmp_path):
    conf = config(tmp_path, publish="direct")

    def crash(at):
        if at == "recorded":
            raise InterruptedError(at)

    with pytest.raises(InterruptedError):
        ingest_batch(log(spark, {0: (0, 20)}), 0, conf, message(), on_step=crash, query_id="old")
    for batch_id, ranges in enumerate([{0: (0, 13)}, {0: (0, 30)}]):
        ingest_batch(log(spark, ranges), batch_id, conf, message(), query_id="new")
    assert offsets(spark, conf) == expect({0: (0, 30)})


def test_an_aborted_job_leaves_nothing(spark, tmp_path):
    conf = config(tmp_path, publish="direct")
    bad = log(spark, {0: (0, 60)}).withColumn("value", F.when(F.col("kafka_offset") == 55, F.lit(b"\xff\xff")).otherwise(F.col("value")))
    with pytest.raises(Exception):
        ingest_batch(bad, 0, conf, message())
    # The last file fails to be written after others are done.
    from harborlog.sinks.direct import write_committed
    from harborlog.sinks.publish import Part

    rows = spark.range(0, 60, 1, 1).select(
        F.lit("t").alias("topic"), F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"), F.lit("p").alias("encoded_partition"),
        F.expr("id div 10").alias("chunk"), F.lit(None).cast("binary").alias("key"),
        F.when(F.col("id") == 55, F.raise_error(F.lit("no"))).otherwise(F.lit("v")).cast("binary").alias("value"),
    )
    part = Part(conf.manifest_root, "s", 0, True)
    with pytest.raises(Exception):
        write_committed(rows, conf.topics_root, part)
    assert files_below(conf.topics_root) == [] and not part.committed()


def test_the_second_commit_of_a_batch_is_refused(spark, tmp_path):
    from harborlog.sinks.direct import write_committed
    from harborlog.sinks.publish import Part

    conf = config(tmp_path, publish="direct")
    rows = spark.createDataFrame([("t", 0, 5, "p", 0, None, b"v")], "topic string, kafka_partition int, kafka_offset long, encoded_partition string, chunk long, key binary, value binary")
    for _ in range(2):
        write_committed(rows, conf.topics_root, Part(conf.manifest_root, "s", 0, True))
    assert len(files_below(conf.topics_root)) == 1
    manifest = read_manifest(spark, conf.manifest_root)
    assert read_committed(spark, conf.topics_root, manifest=manifest).count() == 1
    stray = files_below(conf.topics_root)[0].replace("/o-", "/o-0")
    os.makedirs(os.path.dirname(stray))
    os.link(files_below(conf.topics_root)[0], stray)
    time.sleep(1)
    found = [row.path for row in stray_files(spark, conf.topics_root, manifest, "0 seconds").collect()]
    assert [path.removeprefix("file:") for path in found] == [stray]
    assert read_committed(spark, conf.topics_root, manifest=manifest).count() == 1


def test_one_of_two_puts_wins(tmp_path):
    path = str(tmp_path / "a" / "part-0.parquet")
    assert paths.put_if_absent(path, b"one") and not paths.put_if_absent(path, b"two")
    assert open(path, "rb").read() == b"one" and os.listdir(tmp_path / "a") == ["part-0.parquet"]


def test_many_batches_are_read_through_few_folders(spark, tmp_path):
    root, fan_in, n = str(tmp_path / "manifest"), 4, 150
    for stream in ("s", "other"):
        for batch in range(n if stream == "s" else 2):
            folder = f"{root}/stream_id={stream}/batch_id={batch}"
            os.makedirs(folder)
            rows = {"topic": [f"t{batch % 3}"], "kafka_partition": pa.array([0], pa.int32()), "encoded_partition": ["p"], "start_offset": [batch * 10],
                    "end_offset": [batch * 10 + 9], "n_records": [10], "committed_file": [f"f{batch}"], "path": [f"x/f{batch}"]}
            pq.write_table(pa.table(rows), f"{folder}/part-0.parquet")
            if stream == "s":
                compact_manifest(spark, root, "s", fan_in)
                parts, runs = M.manifest_folders(root)
                assert len(parts) + len(runs) <= 4 * (fan_in - 1) + fan_in + M.NEWEST + 2
    found = sorted((row.stream_id, row.batch_id, row.committed_file) for row in read_manifest(spark, root).collect())
    assert found == sorted([("s", b, f"f{b}") for b in range(n)] + [("other", b, f"f{b}") for b in range(2)])
    assert M.is_covered(root, "s", 0) and not M.is_covered(root, "s", n - 1)
    assert len(paths.subdirectories(f"{root}/stream_id=s")) <= 2 * fan_in + M.NEWEST
    # A run that was not marked does not count, and is written again.
    run = M.runs_of(root, "s")[-1]
    paths.delete_file(f"{run.path}/{M.DONE}")
    assert run not in M.runs_of(root, "s")


def test_ingest_over_many_batches_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "FAN_IN", 3)
    conf = config(tmp_path, publish="direct")
    compact = M.compact_manifest
    monkeypatch.setattr("harborlog.streaming.ingest.compact_manifest", lambda s, root, stream: compact(s, root, stream, 3))
    for batch_id in range(7):
        ingest_batch(log(spark, {0: (batch_id * 5, batch_id * 5 + 7)}), batch_id, conf, message())
    assert M.manifest_folders(conf.manifest_root)[1]
    ingest_batch(log(spark, {0: (0, 7)}), 0, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 37)})
