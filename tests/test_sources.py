import gzip
import io
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from harborlog.operators import files_with_max_offset
from harborlog.plans import new_folder, ranked, running_before, running_total, shared_folder, stored
from harborlog.sources import (
    committed_files,
    from_log_source,
    leaf_directories,
    list_files,
    read_manifest,
    read_sequence,
    rebuild_manifest,
)
from harborlog.sources.sequence import pairs as sequence_pairs


@pytest.fixture
def tree(tmp_path):
    for path in [
        "topics/t/partition=0/t+0+0000000000+0000000009.parquet",
        "topics/t/partition=0/t+0+0000000010+0000000019.parquet",
        "topics/t/year=2024/month=01/t+1+0000000000+0000000004.parquet",
        "topics/t/year=2024/month=01/deep/er/t+1+0000000000+0000000004.parquet",
        "topics/t/partition=0/0c1d_tmp.parquet",
        "topics/+tmp/t/partition=0/t+0+0000000020+0000000029.parquet",
        "topics/t/readme.txt",
    ]:
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"12345")
    return str(tmp_path)


def below(tree, rows, column="path"):
    return sorted(row[column].split(tree, 1)[1] for row in rows.collect())


def test_listing(spark, tree):
    files = list_files(spark, f"{tree}/topics")
    assert files.count() == 7
    assert {row.length for row in files.collect()} == {5}
    assert below(tree, committed_files(files)) == [
        "/topics/t/partition=0/t+0+0000000000+0000000009.parquet",
        "/topics/t/partition=0/t+0+0000000010+0000000019.parquet",
        "/topics/t/year=2024/month=01/deep/er/t+1+0000000000+0000000004.parquet",
        "/topics/t/year=2024/month=01/t+1+0000000000+0000000004.parquet",
    ]


def test_missing_directory_is_an_empty_listing(spark, tree):
    assert list_files(spark, f"{tree}/nowhere").isEmpty()
    assert read_manifest(spark, f"{tree}/nowhere").isEmpty()


def test_listing_does_not_read_contents(spark, tree):
    plan = list_files(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]


def test_leaves(spark, tree):
    leaves = leaf_directories(list_files(spark, f"{tree}/topics"))
    assert below(tree, leaves, "directory") == [
        "/topics/+tmp/t/partition=0",
        "/topics/t/partition=0",
        "/topics/t/year=2024/month=01/deep/er",
    ]


def test_greatest_end_offset_and_ties(spark, tree):
    best = files_with_max_offset(committed_files(list_files(spark, f"{tree}/topics")))
    assert below(tree, best) == [
        "/topics/t/partition=0/t+0+0000000010+0000000019.parquet",
        "/topics/t/year=2024/month=01/deep/er/t+1+0000000000+0000000004.parquet",
    ]


def test_rebuilt_manifest_knows_directories(spark, tree):
    rows = rebuild_manifest(spark, f"{tree}/topics").select("kafka_partition", "encoded_partition", "end_offset")
    assert sorted(tuple(row) for row in rows.collect()) == [
        (0, "partition=0", 9),
        (0, "partition=0", 19),
        (1, "year=2024/month=01", 4),
        (1, "year=2024/month=01/deep/er", 4),
    ]


def test_log_source_columns(spark):
    messages = spark.createDataFrame(
        [(None, bytearray(b"v"), "t", 1, 5)], "key binary, value binary, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.current_timestamp())
    row = from_log_source(messages).first()
    assert (row.topic, row.kafka_partition, row.kafka_offset, row.key, bytes(row.value)) == ("t", 1, 5, None, b"v")


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_sliced_scans_equal_windows(spark, width):
    # One key holds most of the rows.
    frame = spark.range(200).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7).alias("k"),
        (F.col("id") * 3).alias("at"),
        (F.hash("id") % 50).cast("bigint").alias("v"),
    )
    over = "over (partition by k order by at rows between unbounded preceding"
    expected = frame.selectExpr(
        "k", "at", f"row_number() over (partition by k order by at) as rank",
        f"sum(v) {over} and current row) as total", f"max(v) {over} and 1 preceding) as before",
    )
    result = ranked(frame, ["k"], "at", width=width)
    result = running_total(result, ["k"], "at", F.col("v"), "total", width)
    result = running_before(result, ["k"], "at", "v", "before", width)
    result = result.select(expected.columns)
    assert result.exceptAll(expected).isEmpty() and expected.exceptAll(result).isEmpty()


def test_small_stored_sides_are_broadcast_and_large_ones_are_not(spark):
    side = stored(spark.range(100).withColumn("v", F.uuid()))
    rows = spark.range(1000)
    assert "BroadcastHashJoin" in rows.join(side, "id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100)
    try:
        assert "SortMergeJoin" in rows.join(side, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_folders_are_below_the_shared_folder(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def sequence_file(pairs, codec=None):
    """A sequence file of byte pairs with a sync marker after every third."""

    def text(value):
        return bytes([len(value)]) + value.encode()

    def packed(data):
        return struct.pack(">i", len(data)) + data

    marker, writable = bytes(range(16)), "org.apache.hadoop.io.BytesWritable"
    out = b"SEQ\x06" + text(writable) * 2 + (b"\x01\x00" + text(codec) if codec else b"\x00\x00") + struct.pack(">i", 1) + text("a") + text("b") + marker
    for i, (key, value) in enumerate(pairs):
        value = packed(value) if codec is None else zlib.compress(packed(value))
        if codec and codec.endswith("GzipCodec"):
            value = gzip.compress(packed(pairs[i][1]))
        out += struct.pack(">ii", len(key) + 4 + len(value), len(key) + 4) + packed(key) + value
        out += struct.pack(">i", -1) + marker if i % 3 == 2 else b""
    return out


@pytest.mark.parametrize("codec", [None, "org.apache.hadoop.io.compress.DefaultCodec", "org.apache.hadoop.io.compress.GzipCodec"])
def test_sequence_files_by_name_and_by_manifest(spark, tmp_path, codec):
    root = tmp_path / "topics"
    content = [(bytes([i]), b"v" * (i % 7)) for i in range(20)]
    for place in ("t/a/t+0+0+19.seq", "t/a/t+0+20+39.seq", "u/b/u+3+0+19.seq", "+tmp/t/t+0+0+19.seq", "t/a/odd.seq", "t/a/t+0+5+6.parquet"):
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        good = "odd" not in place and "parquet" not in place and "+tmp" not in place
        (root / place).write_bytes(sequence_file(content, codec) if good else b"half")
    rows = read_sequence(spark, str(root)).collect()
    assert sorted({(r.committed_file, r.topic, r.kafka_partition, r.start_offset, r.end_offset) for r in rows}) == [
        ("t+0+0+19.seq", "t", 0, 0, 19), ("t+0+20+39.seq", "t", 0, 20, 39), ("u+3+0+19.seq", "u", 3, 0, 19),
    ]
    assert sorted((bytes(r.key), bytes(r.value)) for r in rows) == sorted(content * 3)
    assert read_sequence(spark, str(root), topic="t").count() == 40
    assert read_sequence(spark, str(root), kafka_partition=3).count() == 20
    manifest = rebuild_manifest(spark, str(root)).where("start_offset = 0")
    assert read_sequence(spark, str(root), manifest).count() == 40
    assert read_sequence(spark, str(root), manifest, topic="u").count() == 20
    assert read_sequence(spark, str(tmp_path / "nothing")).count() == 0


def test_sequence_files_that_are_cut_or_of_another_kind_fail():
    whole = sequence_file([(b"k", b"value")])
    assert list(sequence_pairs(io.BytesIO(whole), "x")) == [(b"k", b"value")]
    for bad in (whole[:-2], whole[:30], b"", b"PAR1" + whole[4:], sequence_file([], "some.Codec"), whole.replace(b"BytesWritable", b"IntsWritables")):
        with pytest.raises((EOFError, ValueError), match="^x "):
            list(sequence_pairs(io.BytesIO(bad), "x"))
