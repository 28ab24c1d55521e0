import random

from models import replay as model

from harborlog.operators import replay

SCHEMA = "topic string, kafka_partition int, seq bigint, key string, value string"


def test_same_as_entry_by_entry(spark):
    rng = random.Random(17)
    rows, existing, sources, expected = [], set(), set(), {}
    for case in range(250):
        topic, entries, number = f"t{case}", [], 0
        for _ in range(rng.randrange(1, 14)):
            kind = rng.choice(["BEGIN", "END", "pair", "pair", "pair"])
            if kind == "pair":
                number += 1
                # Now and then two sources name the same target.
                target = number - 1 if number > 1 and rng.random() < 0.2 else number
                # Or one source is named again.
                source = rng.randrange(1, number) if number > 1 and rng.random() < 0.25 else number
                entries.append((f"{topic}/tmp{source}", f"{topic}/file{target}"))
            else:
                entries.append((kind, ""))
        rows += [(topic, 0, seq, key, value) for seq, (key, value) in enumerate(entries)]
        there = {f"{topic}/file{n}" for n in range(1, number + 1) if rng.random() < 0.2}
        left = {f"{topic}/tmp{n}" for n in range(1, number + 1) if rng.random() < 0.8}
        existing |= there
        sources |= left
        for source, target in model(entries, there, left):
            assert target not in expected
            expected[target] = source
    log = spark.createDataFrame(rows, SCHEMA)
    present = spark.createDataFrame([(name,) for name in existing], "committed_file string")
    staged = spark.createDataFrame([(name,) for name in sources], "temp_file string")
    for width in (2, 1 << 16):
        result = replay(log, present, staged, width).collect()
        assert {row.committed_file: row.temp_file for row in result} == expected
        assert len(result) == len(expected)


def test_log_without_end_is_not_replayed(spark):
    log = spark.createDataFrame([("t", 0, 0, "BEGIN", ""), ("t", 0, 1, "a", "b")], SCHEMA)
    assert replay(log).isEmpty()
