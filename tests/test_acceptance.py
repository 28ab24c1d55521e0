import random

import pytest
from models import accept

from harborlog.operators import accept_monotonic, accept_strict
from harborlog.operators import acceptance

SCHEMA = "topic string, kafka_partition int, kafka_offset bigint, arrival_seq bigint"


def random_log(rng):
    """Stretches of a log with rewinds, gaps and repeats."""
    log, at = [], rng.randrange(0, 5)
    for _ in range(rng.randrange(1, 9)):
        n = rng.randrange(1, 9)
        log += range(at, at + n)
        at = max(0, at + n + rng.choice([0, 0, 0, -1, -2, -5, 1, 3]))
    if rng.random() < 0.2:
        rng.shuffle(log)
    return log


@pytest.fixture(scope="module")
def logs():
    rng = random.Random(7)
    return {(f"t{case}", case % 3): random_log(rng) for case in range(120)}


@pytest.fixture(scope="module")
def records(spark, logs):
    rows = [(*tp, offset, at) for tp, log in logs.items() for at, offset in enumerate(log)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def known(logs):
    rng = random.Random(11)
    return {tp: rng.choice([-1, 0, 2, log[0], log[0] + 3]) for tp, log in logs.items() if rng.random() < 0.7}


def places(frame):
    out = {}
    for row in frame.collect():
        out.setdefault((row.topic, row.kafka_partition), []).append(row.arrival_seq)
    return {tp: sorted(seqs) for tp, seqs in out.items()}


def expected(logs, strict, known):
    model = {tp: accept(log, strict, None if known.get(tp, -1) < 0 else known[tp]) for tp, log in logs.items()}
    return {tp: kept for tp, kept in model.items() if kept}


@pytest.mark.parametrize("width", [1, 5, 1 << 16])
@pytest.mark.parametrize("operator, strict", [(accept_strict, True), (accept_monotonic, False)])
def test_same_as_record_by_record(records, logs, operator, strict, width):
    assert places(operator(records, width=width)) == expected(logs, strict, {})


@pytest.mark.parametrize("operator, strict", [(accept_strict, True), (accept_monotonic, False)])
def test_committed_positions_are_respected(spark, records, logs, known, operator, strict):
    rows = [(*tp, position) for tp, position in known.items()]
    positions = spark.createDataFrame(rows, "topic string, kafka_partition int, next_offset bigint")
    assert places(operator(records, positions, width=5)) == expected(logs, strict, known)


def test_large_offsets_keep_all_digits(spark):
    start = (1 << 60) + 1
    rows = [("t", 0, start + at, at) for at in range(20)]
    frame = accept_strict(spark.createDataFrame(rows, SCHEMA), width=4)
    assert sorted(row.kafka_offset for row in frame.collect()) == [start + at for at in range(20)]


def test_other_columns_pass_through(spark):
    frame = spark.createDataFrame([("t", 0, 5, 0, b"x"), ("t", 0, 5, 1, b"y")], SCHEMA + ", value binary")
    assert [bytes(row.value) for row in accept_strict(frame).collect()] == [b"x"]
    assert [bytes(row.value) for row in accept_monotonic(frame).collect()] == [b"x"]


def every_second(n):
    return [("t", 0, at, at) for at in range(0, n, 2)]


def test_walk_holds_a_row_per_bucket_where_every_second_offset_is_missing(spark, monkeypatch):
    """The streaming pass, the only task that a hot topic-partition has to itself, sees none of the single runs."""
    n, width = 40_000, 100
    walked = spark.sparkContext.accumulator(0)
    enter = acceptance._enter_buckets

    def counting(batches):
        def counted():
            for batch in batches:
                walked.add(len(batch))
                yield batch

        return enter(counted())

    monkeypatch.setattr(acceptance, "_enter_buckets", counting)
    late = [("t", 0, at, n + at) for at in range(1, n, 2)]
    again = [("t", 0, at, 2 * n + at) for at in range(n)]
    frame = spark.createDataFrame(every_second(n) + late + again, SCHEMA)
    kept = [(row.kafka_offset, row.arrival_seq) for row in accept_strict(frame, width=width).collect()]
    # Offset 0, then 1 when it comes late, then the rest when all is delivered again.
    assert sorted(kept) == [(0, 0), (1, n + 1)] + [(at, 2 * n + at) for at in range(2, n)]
    assert 0 < walked.value <= 4 * n // width


def test_a_hot_offset_is_one_run_of_its_slice(spark):
    rows = [("t", 0, 7, at) for at in range(5000)] + [("t", 0, 8, 5000)]
    assert places(accept_strict(spark.createDataFrame(rows, SCHEMA))) == {("t", 0): [0, 5000]}


@pytest.mark.parametrize("width", [2, 3, 8])
def test_start_inside_and_between_buckets(spark, width):
    rng = random.Random(width)
    logs = {(f"t{case}", 0): [rng.randrange(0, 14) for _ in range(rng.randrange(1, 40))] for case in range(60)}
    known = {tp: rng.randrange(0, 14) for tp in logs if rng.random() < 0.5}
    records = spark.createDataFrame([(*tp, o, at) for tp, log in logs.items() for at, o in enumerate(log)], SCHEMA)
    positions = spark.createDataFrame([(*tp, p) for tp, p in known.items()], "topic string, kafka_partition int, next_offset bigint")
    assert places(accept_strict(records, positions, width=width)) == expected(logs, True, known)
