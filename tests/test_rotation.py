import random

import pytest
from models import rotate as model
from pyspark.sql import functions as F

from harborlog.functions import by_kafka_partition
from harborlog.operators import (
    chunk_bases,
    closed_chunks,
    file_order,
    file_plan,
    rotate,
    rotate_by_count,
    rotate_ranked,
    with_directory,
)
from harborlog.operators.rotation import batch_rotations

SCHEMA = "topic string, kafka_partition int, kafka_offset bigint, now_ms bigint"


@pytest.fixture(scope="module")
def deliveries():
    rng = random.Random(13)
    cases = {}
    for case in range(200):
        clock, batches = rng.randrange(0, 40), []
        for _ in range(rng.randrange(1, 9)):
            clock += rng.randrange(1, 30)
            batches.append((clock, rng.randrange(1, 12)))
        cases[f"t{case}"] = (rng.randrange(0, 1000), batches)
    return cases


def frame(spark, deliveries, step=1):
    rows = []
    for topic, (base, batches) in deliveries.items():
        offset = base
        for now, n in batches:
            for _ in range(n):
                rows.append((topic, 0, offset, now))
                offset += step
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def chunks(result):
    out = {}
    for row in result.orderBy("topic", "kafka_offset").collect():
        out.setdefault(row.topic, []).append(row.chunk)
    return out


@pytest.mark.parametrize("flush_size, interval, start", [(3, 25, 0), (1 << 40, 20, 0), (4, -1, 0), (5, 40, 30)])
@pytest.mark.parametrize("step", [1, 7])
def test_same_as_record_by_record(spark, deliveries, flush_size, interval, start, step):
    records = frame(spark, deliveries, step)
    result = rotate(records, "now_ms", flush_size, interval, start, contiguous=step == 1, width=5)
    assert chunks(result) == {t: model(batches, flush_size, interval, start) for t, (_, batches) in deliveries.items()}


def test_closed_chunks(spark, deliveries):
    folded = batch_rotations(frame(spark, deliveries), "now_ms", 3, 25)
    closed = {row.topic: row.closed for row in closed_chunks(folded).collect()}
    for topic, (_, batches) in deliveries.items():
        # A record more shows which chunk is open.
        longer = model([*batches, (batches[-1][0], 1)], 3, 25)
        assert closed[topic] == longer[-1]


def test_count_starts_at_the_committed_position(spark):
    rows = [("t", 0, offset, 0) for offset in range(12, 30)] + [("u", 0, offset, 0) for offset in range(5, 9)]
    positions = spark.createDataFrame([("t", 0, 10), ("u", 0, -1)], "topic string, kafka_partition int, next_offset bigint")
    records = spark.createDataFrame(rows, SCHEMA)
    result = chunks(rotate_by_count(records, 10, chunk_bases(records, positions)))
    assert result == {"t": [0] * 8 + [1] * 10, "u": [0] * 4}


def test_ranked_rotation_counts_records(spark):
    rows = [("t", 0, offset, 0) for offset in range(0, 200, 3)]
    result = chunks(rotate_ranked(spark.createDataFrame(rows, SCHEMA), 10, width=16))
    assert result["t"] == [at // 10 for at in range(len(rows))]


def test_plan_covers_every_record_once(spark, deliveries):
    records = with_directory(frame(spark, deliveries), by_kafka_partition())
    plan = file_plan(rotate_by_count(records, 4), 4)
    assert plan.agg(F.sum("n_records")).first()[0] == records.count()
    assert plan.where("complete and n_records <> 4").isEmpty()
    assert plan.where("end_offset - start_offset + 1 <> n_records").isEmpty()
    assert plan.select("committed_file").distinct().count() == plan.count()


def test_order_in_file(spark, deliveries):
    records = with_directory(frame(spark, deliveries), by_kafka_partition())
    placed = file_order(rotate_by_count(records, 4))
    assert placed.where("place > 4").isEmpty()
