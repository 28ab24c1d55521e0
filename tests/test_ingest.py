import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from harborlog import IngestConfig
from harborlog.operators import PERMISSIVE, encode
from harborlog.sinks import FORMATS, SequenceFormat, TableFormat, format_for, publish
from harborlog.sources import ENVELOPE, list_files, read_committed, read_manifest, read_sequence
from harborlog.streaming import Positions, ingest_batch, start_ingest
from workload.fixtures import message

STEPS = ["staged", "published", "recorded", "committed"]


def log(spark, ranges, topic="t"):
    """Records of offsets [start, stop) per partition, with a message that says where it comes from."""
    rows = [(topic, p, offset) for p, (start, stop) in ranges.items() for offset in range(start, stop)]
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, "topic string, kafka_partition int, kafka_offset bigint")
    number = F.col("kafka_partition") * 1_000_000 + F.col("kafka_offset")
    protocol = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("kafka_offset") % 3 + 1).cast("int"))
    value = encode(message(), {"event_id": number, "protocol": protocol})
    return frame.select("topic", "kafka_partition", "kafka_offset", F.lit(None).cast("binary").alias("key"), value.alias("value"))


def config(tmp_path, **settings):
    return IngestConfig(**{"base_path": str(tmp_path / "out"), "flush_size": 10, **settings})


def offsets(spark, conf):
    """Every published (partition, offset), in the order of partition and offset; repeats show."""
    rows = read_committed(spark, conf.topics_root, manifest=read_manifest(spark, conf.manifest_root))
    return sorted((row.kafka_partition, row.event_id % 1_000_000) for row in rows.collect())


def expect(ranges):
    return sorted((p, offset) for p, (start, stop) in ranges.items() for offset in range(start, stop))


def test_layout_names_and_format(spark, tmp_path):
    conf = config(tmp_path, partitioner="protocol")
    ingest_batch(log(spark, {0: (0, 25)}), 0, conf, message())
    files = sorted(path.split("/topics/")[1] for path in glob.glob(f"{conf.topics_root}/t/*/*"))
    assert files == [
        "t/a/t+0+0000000000+0000000009.parquet",
        "t/a/t+0+0000000012+0000000018.parquet",
        "t/a/t+0+0000000021+0000000024.parquet",
        "t/b/t+0+0000000001+0000000007.parquet",
        "t/b/t+0+0000000010+0000000019.parquet",
        "t/b/t+0+0000000022+0000000022.parquet",
        "t/unknown/t+0+0000000002+0000000008.parquet",
        "t/unknown/t+0+0000000011+0000000017.parquet",
        "t/unknown/t+0+0000000020+0000000023.parquet",
    ]
    first = pq.ParquetFile(f"{conf.topics_root}/{files[0]}")
    assert first.metadata.row_group(0).column(0).compression == "SNAPPY"
    assert first.read(["event_id"]).column(0).to_pylist() == [0, 3, 6, 9]
    assert glob.glob(f"{conf.topics_root}/_staging/*") == []
    manifest = read_manifest(spark, conf.manifest_root)
    assert manifest.agg(F.sum("n_records")).first()[0] == 25
    assert {row.path.rsplit("/topics/", 1)[1] for row in manifest.collect()} == set(files)


def test_records_of_a_file_are_in_offset_order(spark, tmp_path):
    conf = config(tmp_path, flush_size=500)
    ingest_batch(log(spark, {p: (0, 2000) for p in range(3)}).repartition(7), 0, conf, message())
    files = glob.glob(f"{conf.topics_root}/t/*/*.parquet")
    assert len(files) == 12
    for file in files:
        ids = pq.read_table(file, columns=["event_id"]).column(0).to_pylist()
        assert ids == list(range(ids[0], ids[0] + 500))


def test_overlap_and_replay(spark, tmp_path):
    conf = config(tmp_path)
    ingest_batch(log(spark, {0: (0, 33), 1: (5, 20)}), 0, conf, message())
    ingest_batch(log(spark, {0: (0, 33), 1: (5, 20)}), 0, conf, message())
    ingest_batch(log(spark, {0: (20, 60), 1: (5, 41), 2: (7, 9)}), 1, conf, message())
    ingest_batch(log(spark, {0: (20, 60), 1: (5, 41), 2: (7, 9)}), 1, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 60), 1: (5, 41), 2: (7, 9)})
    positions = {row.kafka_partition: row.next_offset for row in Positions(conf.manifest_root, conf.stream_id).read(spark).collect()}
    assert positions == {0: 60, 1: 41, 2: 9}


@pytest.mark.parametrize("step, output", [*((step, "parquet") for step in STEPS), ("published", "sequence")])
def test_crash_after_each_step(spark, tmp_path, step, output):
    conf = config(tmp_path, format=output, partitioner="protocol")

    def crash(at):
        if at == step:
            raise InterruptedError(at)

    for batch_id, ranges in enumerate([{0: (0, 25), 1: (0, 7)}, {0: (20, 48), 1: (7, 31)}]):
        with pytest.raises(InterruptedError):
            ingest_batch(log(spark, ranges), batch_id, conf, message(), on_step=crash)
        ingest_batch(log(spark, ranges), batch_id, conf, message())
    whole = {0: (0, 48), 1: (0, 31)}
    if output == "parquet":
        assert offsets(spark, conf) == expect(whole)
    else:
        assert read_sequence(spark, conf.topics_root).count() == len(expect(whole))
    manifest = read_manifest(spark, conf.manifest_root)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(expect(whole))
    # What is published is what the manifest lists, no more.
    listed = list_files(spark, conf.topics_root, "*+*+*+*")
    assert listed.count() == manifest.count()


@pytest.mark.parametrize("step", STEPS)
def test_crash_after_each_step_with_a_new_checkpoint(spark, tmp_path, step):
    conf = config(tmp_path, partitioner="protocol")

    def crash(at):
        if at == step:
            raise InterruptedError(at)

    with pytest.raises(InterruptedError):
        ingest_batch(log(spark, {0: (0, 20)}), 0, conf, message(), on_step=crash, query_id="old")
    for batch_id, ranges in enumerate([{0: (0, 13)}, {0: (0, 30)}]):
        ingest_batch(log(spark, ranges), batch_id, conf, message(), query_id="new")
    assert offsets(spark, conf) == expect({0: (0, 30)})


def test_a_held_tail_is_published_once(spark, tmp_path):
    for batch_id, (start, stop) in enumerate([(0, 15), (15, 17), (17, 20), (20, 22)]):
        conf = config(tmp_path, publish_tail=batch_id > 0)
        ingest_batch(log(spark, {0: (start, stop)}), batch_id, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 22)})


def test_other_streams_count(spark, tmp_path):
    ingest_batch(log(spark, {0: (0, 30)}), 0, config(tmp_path, stream_id="one"), message())
    conf = config(tmp_path, stream_id="two")
    ingest_batch(log(spark, {0: (10, 45)}), 0, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 45)})


def test_gap_stops_strict_and_not_monotonic(spark, tmp_path):
    gapped = log(spark, {0: (0, 40)}).where("kafka_offset <> 17")
    strict = config(tmp_path / "s")
    ingest_batch(gapped, 0, strict, message())
    assert offsets(spark, strict) == expect({0: (0, 17)})
    ingest_batch(log(spark, {0: (17, 40)}), 1, strict, message())
    assert offsets(spark, strict) == expect({0: (0, 40)})
    loose = config(tmp_path / "m", acceptance="monotonic")
    ingest_batch(gapped, 0, loose, message())
    assert offsets(spark, loose) == [(0, offset) for offset in range(40) if offset != 17]


@pytest.mark.parametrize("acceptance", ["strict", "monotonic"])
def test_redelivery_within_a_batch(spark, tmp_path, acceptance):
    conf = config(tmp_path, acceptance=acceptance)
    records = log(spark, {0: (0, 30)})
    twice = records.withColumn("arrival_seq", F.col("kafka_offset")).unionByName(
        records.where("kafka_offset >= 22").withColumn("arrival_seq", F.col("kafka_offset") + 100)
    )
    ingest_batch(twice, 0, conf, message(), arrival="arrival_seq")
    assert offsets(spark, conf) == expect({0: (0, 30)})


@pytest.mark.parametrize("acceptance", ["strict", "monotonic"])
def test_tail_is_read_again(spark, tmp_path, acceptance):
    conf = config(tmp_path, publish_tail=False, acceptance=acceptance)
    ingest_batch(log(spark, {0: (0, 25), 1: (0, 9)}), 0, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 20)})
    ingest_batch(log(spark, {0: (20, 31), 1: (0, 10)}), 1, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 30), 1: (0, 10)})


def test_dead_letters_do_not_hold_up_the_log(spark, tmp_path):
    conf = config(tmp_path)
    bad = F.col("kafka_offset").isin(3, 24)
    records = log(spark, {0: (0, 25)}).withColumn("value", F.when(bad, F.lit(b"\x0a\xff")).otherwise(F.col("value")))
    dead = str(tmp_path / "dead")
    for _ in range(2):
        ingest_batch(records, 0, conf, message(), PERMISSIVE, dead)
    # The last record of the batch was a dead letter; the next one still fits on.
    ingest_batch(log(spark, {0: (25, 30)}), 1, conf, message(), PERMISSIVE, dead)
    assert offsets(spark, conf) == [(0, offset) for offset in range(30) if offset not in (3, 24)]
    letters = spark.read.parquet(dead)
    assert sorted(row.kafka_offset for row in letters.collect()) == [3, 24]
    assert {bytes(row.value) for row in letters.collect()} == {b"\x0a\xff"}


def test_dead_letters_with_sequence_files(spark, tmp_path):
    conf = config(tmp_path, format="sequence")
    records = log(spark, {0: (0, 25)}).withColumn(
        "value", F.when(F.col("kafka_offset") == 3, F.lit(b"\x0a\xff")).otherwise(F.col("value"))
    )
    ingest_batch(records, 0, conf, message(), PERMISSIVE, str(tmp_path / "dead"))
    assert read_sequence(spark, conf.topics_root).count() == 24


def test_sequence_file_contents(spark, tmp_path):
    conf = config(tmp_path, format=SequenceFormat(clock=F.col("kafka_offset") + 1_700_000_000_000))
    ingest_batch(log(spark, {0: (0, 25), 1: (0, 5)}), 0, conf, message())
    names = sorted(path.rsplit("/", 1)[1] for path in glob.glob(f"{conf.topics_root}/t/*/*.seq"))
    assert names == [
        "t+0+0000000000+0000000009.seq", "t+0+0000000010+0000000019.seq", "t+0+0000000020+0000000024.seq",
        "t+1+0000000000+0000000004.seq",
    ]
    pairs = spark.sparkContext.sequenceFile(f"{conf.topics_root}/t/partition=0/{names[1]}").collect()
    assert [int.from_bytes(key, "big") - 1_700_000_000_000 for key, _ in pairs] == list(range(10, 20))
    assert message().message_class().FromString(bytes(pairs[0][1])).event_id == 10


def test_user_format_and_partitioner(spark, tmp_path):
    conf = config(
        tmp_path, format=TableFormat("json", ".json"), partitioner=lambda records: F.lit("x/y"), zero_pad_width=3
    )
    ingest_batch(log(spark, {0: (0, 12)}), 0, conf, message())
    names = sorted(path.split("/topics/")[1] for path in glob.glob(f"{conf.topics_root}/t/x/y/*"))
    assert names == ["t/x/y/t+0+000+009.json", "t/x/y/t+0+010+011.json"]
    assert spark.read.json(f"{conf.topics_root}/{names[0]}").count() == 10


def test_without_a_message_bytes_are_kept(spark, tmp_path):
    conf = config(tmp_path)
    ingest_batch(log(spark, {0: (0, 12)}), 0, conf)
    assert read_committed(spark, conf.topics_root).where("value is not null").count() == 12


def test_empty_batch(spark, tmp_path):
    conf = config(tmp_path)
    empty = spark.createDataFrame([], ENVELOPE)
    for batch_id, batch in enumerate([empty, log(spark, {0: (0, 5)}), empty, log(spark, {0: (5, 8)})]):
        ingest_batch(batch, batch_id, conf, message())
    assert offsets(spark, conf) == expect({0: (0, 8)})


def test_publishing_refuses_what_was_not_staged(spark, tmp_path):
    files = spark.createDataFrame([("i", f"{tmp_path}/a")], "file_id string, path string")
    none = spark.createDataFrame([], "file_id string, staged_path string")
    with pytest.raises(Exception, match="nothing staged"):
        publish(files, none).collect()
    (tmp_path / "p0").write_text("x")
    (tmp_path / "p1").write_text("y")
    two = spark.createDataFrame([("i", f"{tmp_path}/p{n}") for n in (0, 1)], "file_id string, staged_path string")
    with pytest.raises(Exception, match="several staged"):
        publish(files, two).collect()


def test_publishing_keeps_an_existing_target(spark, tmp_path):
    (tmp_path / "a").write_text("old")
    (tmp_path / "s").write_text("new")
    files = spark.createDataFrame([("i", f"file:{tmp_path}/a")], "file_id string, path string")
    staged = spark.createDataFrame([("i", f"file:{tmp_path}/s")], "file_id string, staged_path string")
    assert publish(files, staged).count() == 1
    assert (tmp_path / "a").read_text() == "old"


def test_stream_equals_batch(spark, tmp_path):
    records = log(spark, {0: (0, 60), 1: (0, 35)})
    stream_conf = config(tmp_path / "stream", partitioner="protocol")
    source = str(tmp_path / "log")
    for start, stop in [(0, 20), (15, 41), (41, 60)]:
        records.where((F.col("kafka_offset") >= start) & (F.col("kafka_offset") < stop)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE).parquet(source)
        query = start_ingest(stream, stream_conf, str(tmp_path / "checkpoint"), message(), availableNow=True)
        query.awaitTermination()
    batch_conf = config(tmp_path / "batch", partitioner="protocol")
    ingest_batch(records, 0, batch_conf, message())
    assert offsets(spark, stream_conf) == offsets(spark, batch_conf) == expect({0: (0, 60), 1: (0, 35)})


def test_settings():
    for bad in [{"base_path": ""}, {"flush_size": 0}, {"zero_pad_width": -1}, {"acceptance": "some"}]:
        with pytest.raises(ValueError):
            IngestConfig(**{"base_path": "b", "flush_size": 1, **bad})
    conf = IngestConfig(base_path="b/", flush_size=1)
    assert (conf.topics_root, conf.rotate_interval_ms, conf.zero_pad_width) == ("b/topics", -1, 10)
    assert format_for("parquet") is FORMATS["parquet"]
    with pytest.raises(ValueError):
        format_for("avro")


def deliver(spark, conf, tmp_path, parts, name="checkpoint", **options):
    """Stream a folder that grows by one part after another."""
    folder = str(tmp_path / f"log-{name}")
    for part in parts:
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        start_ingest(stream, conf, str(tmp_path / name), message(), availableNow=True, **options).awaitTermination()


@pytest.mark.parametrize("acceptance", ["strict", "monotonic"])
def test_tail_is_held_between_micro_batches(spark, tmp_path, acceptance):
    conf = config(tmp_path, publish_tail=False, acceptance=acceptance)
    deliver(spark, conf, tmp_path, [log(spark, {0: (0, 23), 1: (0, 4)}), log(spark, {0: (23, 48)}), log(spark, {0: (48, 63), 1: (4, 12)})])
    assert offsets(spark, conf) == expect({0: (0, 60), 1: (0, 10)})
    files = read_manifest(spark, conf.manifest_root).collect()
    assert sorted((r.kafka_partition, r.start_offset, r.end_offset) for r in files) == [
        (0, 0, 9), (0, 10, 19), (0, 20, 29), (0, 30, 39), (0, 40, 49), (0, 50, 59), (1, 0, 9)
    ]


def test_time_closes_files_held_open(spark, tmp_path):
    conf = config(tmp_path, publish_tail=False, rotate_interval_ms=1000)
    for n, (start, stop, clock) in enumerate([(0, 4, 0), (4, 6, 500), (6, 9, 1200), (9, 11, 1300)]):
        ingest_batch(log(spark, {0: (start, stop)}), n, conf, message(), clock_ms=clock + 10_000)
    # The first record of the third batch closes the file that it joins.
    assert offsets(spark, conf) == expect({0: (0, 7)})
    held = spark.read.parquet(f"{conf.manifest_root}/stream_id=ingest/batch_id=3/_held")
    assert sorted(r.kafka_offset for r in held.collect()) == [7, 8, 9, 10]


def test_new_checkpoint_continues_after_what_is_published(spark, tmp_path):
    for tail in (True, False):
        conf = config(tmp_path / str(tail), publish_tail=tail)
        records = [log(spark, {0: (0, 20), 1: (0, 5)}), log(spark, {0: (20, 34), 1: (5, 10)})]
        deliver(spark, conf, tmp_path, records[:1], f"one-{tail}")
        deliver(spark, conf, tmp_path, records, f"two-{tail}")
        assert offsets(spark, conf) == expect({0: (0, 34 if tail else 30), 1: (0, 10)})


def test_two_queries_on_one_base_path(spark, tmp_path):
    conf = config(tmp_path)
    deliver(spark, conf, tmp_path, [log(spark, {0: (0, 5)}, "t")], "one")
    deliver(spark, conf, tmp_path, [log(spark, {3: (0, 5)}, "u")], "two")
    assert offsets(spark, conf) == expect({0: (0, 5), 3: (0, 5)})


def test_replay_keeps_the_clock_of_the_first_attempt(spark, tmp_path):
    conf = config(tmp_path, partitioner="time", partition_duration_ms=1000, path_format="HH-mm-ss")

    def fail(step):
        if step == "published":
            raise InterruptedError(step)

    with pytest.raises(InterruptedError):
        ingest_batch(log(spark, {0: (0, 15)}), 0, conf, message(), on_step=fail, clock_ms=1_000)
    ingest_batch(log(spark, {0: (0, 15)}), 0, conf, message(), clock_ms=99_000)
    assert offsets(spark, conf) == expect({0: (0, 15)})
    assert {path.rsplit("/", 2)[1] for path in glob.glob(f"{conf.topics_root}/t/*/*.parquet")} == {"00-00-01"}


def test_orphan_of_the_same_name_elsewhere_is_not_trusted(spark, tmp_path):
    conf = config(tmp_path)
    ingest_batch(log(spark, {0: (0, 10)}), 0, conf, message())
    (source,) = glob.glob(f"{conf.topics_root}/t/*/*.parquet")
    other = tmp_path / "out/topics/t/other"
    other.mkdir()
    (other / source.rsplit("/", 1)[1]).write_bytes(open(source, "rb").read())
    assert offsets(spark, conf) == expect({0: (0, 10)})
    narrowed = read_committed(spark, conf.topics_root, manifest=read_manifest(spark, conf.manifest_root), topic="t", kafka_partition=0)
    assert narrowed.count() == 10


@pytest.mark.parametrize("acceptance", ["strict", "monotonic"])
def test_a_duplicate_does_not_make_up_for_a_gap(spark, tmp_path, acceptance):
    conf = config(tmp_path, acceptance=acceptance)
    records = log(spark, {0: (0, 4)}).where("kafka_offset <> 2")
    ingest_batch(records.unionByName(records.where("kafka_offset = 1")), 0, conf, message())
    assert offsets(spark, conf) == [(0, 0), (0, 1)] + ([] if acceptance == "strict" else [(0, 3)])
    known = spark.read.parquet(f"{conf.manifest_root}/stream_id=ingest/batch_id=0/_positions").first()
    assert known.n_dropped == (2 if acceptance == "strict" else 1)


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    from harborlog.plans import shared_folder

    conf = config(tmp_path)
    before = set(glob.glob(f"{shared_folder(spark)}/harborlog/ingest-*"))
    for n in range(3):
        ingest_batch(log(spark, {0: (n * 7, n * 7 + 7)}), n, conf, message())
    assert set(glob.glob(f"{shared_folder(spark)}/harborlog/ingest-*")) == before
