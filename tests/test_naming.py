import pytest
from pyspark.sql import functions as F

from harborlog import functions as H


def evaluate(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame.select(column.alias("out")).first().out


def name_of(spark, topic, partition, start, end, extension=".parquet", width=10):
    column = H.committed_name(F.lit(topic), F.lit(partition), F.lit(start), F.lit(end), extension, width)
    return evaluate(spark, column)


def test_padding(spark):
    assert name_of(spark, "t", 3, 7, 99) == "t+3+0000000007+0000000099.parquet"
    assert name_of(spark, "t", 3, 7, 123456789012) == "t+3+0000000007+123456789012.parquet"
    assert name_of(spark, "t", 3, 7, 99, ".seq", 0) == "t+3+7+99.seq"
    with pytest.raises(ValueError):
        H.committed_name(F.lit("t"), F.lit(0), F.lit(0), F.lit(0), "", -1)


@pytest.mark.parametrize("topic", ["t", "a.b", "a-b_c.d"])
@pytest.mark.parametrize("extension", [".parquet", ".seq", ""])
def test_names_can_be_read_back(spark, topic, extension):
    name = name_of(spark, topic, 12, 5, 1 << 40, extension)
    parsed = evaluate(spark, H.parsed_name(F.lit(name)))
    assert parsed.asDict() == {
        "topic": topic, "kafka_partition": 12, "start_offset": 5, "end_offset": 1 << 40, "extension": extension
    }


@pytest.mark.parametrize(
    "name, committed",
    [
        ("a.b+0+0000000000+0000000099.parquet", True),
        ("t+0+1+2", True),
        ("t+0+1+2xparquet", True),
        ("t+0+1+2.a.b", False),
        ("x_tmp.parquet", False),
        ("t+0+1", False),
        ("t+1+0000000000+123456789012.seq", True),
        ("päth+0+1+2", False),
        ("", False),
    ],
)
def test_committed_names(spark, name, committed):
    assert evaluate(spark, H.is_committed(F.lit(name))) is committed
    assert (evaluate(spark, H.parsed_name(F.lit(name))) is not None) is committed


def test_filters_by_part(spark):
    name = F.lit("a.b+2+0000000010+0000000019.parquet")
    assert evaluate(spark, H.of_topic(name, "a.b"))
    assert not evaluate(spark, H.of_topic(name, "a"))
    assert evaluate(spark, H.of_topic_partition(name, "a.b", 2))
    assert not evaluate(spark, H.of_topic_partition(name, "a.b", 0))
    assert evaluate(spark, H.has_end_offset(name, 19))
    assert not evaluate(spark, H.has_end_offset(F.lit("x_tmp.parquet"), 19))


@pytest.mark.parametrize(
    "path, temporary",
    [
        ("/d/topics/+tmp/t/partition=0/0c1d_tmp.parquet", True),
        ("/d/topics/t/0c1d_tmp.seq", True),
        ("/d/topics/t/partition=0/t+0+1+2.parquet", False),
        ("+tmp/t/f", True),
    ],
)
def test_files_in_progress(spark, path, temporary):
    assert evaluate(spark, H.is_temporary(F.lit(path))) is temporary


def test_temporary_names_differ(spark):
    rows = spark.range(5).select(H.temporary_name(".seq").alias("n")).collect()
    assert len({row.n for row in rows}) == 5 and all(row.n.endswith("_tmp.seq") for row in rows)


def test_paths(spark):
    directory = H.relative_directory(F.lit("t"), F.lit("partition=1"))
    assert evaluate(spark, directory) == "t/partition=1"
    assert evaluate(spark, H.joined_path("hdfs://h:1", "topics", directory, F.lit("f"))) == "hdfs://h:1/topics/t/partition=1/f"
    assert evaluate(spark, H.log_path("hdfs://h:1", "logs", F.lit("t"), F.lit(1))) == "hdfs://h:1/logs/t/1/log"


def test_time_key(spark):
    assert evaluate(spark, F.hex(H.time_key(F.lit(1704067200000)))) == "0000018CC251F400"
    assert evaluate(spark, F.hex(H.time_key(F.lit(-1)))) == "F" * 16
    assert evaluate(spark, H.time_key(F.lit(None).cast("bigint"))) is None


def test_raw_bytes(spark):
    assert bytes(evaluate(spark, H.raw_bytes(F.lit("é")))) == "é".encode()
    assert evaluate(spark, H.raw_bytes(F.lit(None).cast("string"))) is None


def tokens(spark, partitioner, millis):
    frame = spark.createDataFrame([(ms, 3, "x") for ms in millis], "ms bigint, kafka_partition int, field string")
    return [row.out for row in frame.select(partitioner(frame).alias("out")).collect()]


def test_partitioners(spark):
    assert tokens(spark, H.by_kafka_partition(), [0]) == ["partition=3"]
    assert tokens(spark, H.by_field("field"), [0]) == ["field=x"]
    assert tokens(spark, H.by_payload_field("field"), [0]) == ["x"]
    assert tokens(spark, H.partitioner_for(lambda frame: F.lit("own")), [0]) == ["own"]
    with pytest.raises(ValueError):
        H.partitioner_for("nonsense")
    with pytest.raises(ValueError):
        H.by_field("")


def test_time_partitioner(spark):
    path_format = "'year'=YYYY/'month'=MM/'day'=dd/'hour'=HH/"
    by_hour = H.by_time(F.col("ms"), 3_600_000, path_format)
    # 2024-12-30 lies in the first week-year of 2025; the calendar year is what is meant.
    assert tokens(spark, by_hour, [1735564261234]) == ["year=2024/month=12/day=30/hour=13"]
    local = H.by_time(F.col("ms"), 3_600_000, path_format, "America/New_York")
    assert tokens(spark, local, [1735564261234]) == ["year=2024/month=12/day=30/hour=08"]
    assert tokens(spark, H.by_time(F.col("ms"), 600_000, "HHmm"), [-1]) == ["2350"]
    with pytest.raises(ValueError):
        H.by_time(F.col("ms"), -1, path_format)
    assert tokens(spark, H.by_time(F.col("ms"), 1000, "MMMM", locale="fr"), [0, None]) == ["janvier", "null"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tokens(spark, H.by_time(F.col("ms"), 1000, "yyyy-MM-dd-HH", "Asia/Tehran"), [1704066300000]) == ["2024-01-01-03"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(tokens(spark, H.by_time(None, 1000, "yyyy"), [0])[0]) == 4
