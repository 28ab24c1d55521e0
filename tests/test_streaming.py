import random

import pytest
from models import accept

from harborlog.streaming import start_accept, stream_accept

SCHEMA = "topic string, kafka_partition int, kafka_offset bigint, arrival_seq bigint"


@pytest.mark.parametrize("mode", ["strict", "monotonic"])
@pytest.mark.parametrize("stateful", [True, False])
def test_positions_carry_over_restarts(spark, tmp_path, mode, stateful):
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    rng = random.Random(19)
    logs = {}
    for case in range(20):
        at, offsets = rng.randrange(0, 5), []
        for _ in range(6):
            n = rng.randrange(1, 7)
            offsets += range(at, at + n)
            at = max(0, at + n + rng.choice([0, 0, -2, 1]))
        logs[f"t{case}"] = offsets
    rows = [(topic, 0, offset, seq) for topic, log in logs.items() for seq, offset in enumerate(log)]
    for low, high in [(0, 6), (6, 13), (13, 1000)]:
        part = [row for row in rows if low <= row[3] < high]
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(str(tmp_path / "log"))
        log, checkpoint = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "log")), str(tmp_path / "checkpoint")
        if stateful:
            writer = stream_accept(log, mode=mode).writeStream.format("parquet").trigger(availableNow=True)
            query = writer.option("checkpointLocation", checkpoint).start(str(tmp_path / "out"))
        else:
            query = start_accept(log, str(tmp_path / "parts"), checkpoint, mode=mode, availableNow=True)
        query.awaitTermination()
    expected = {topic: accept(log, mode == "strict") for topic, log in logs.items()}
    if not stateful:
        rows = spark.read.schema(SCHEMA).parquet(str(tmp_path / "parts" / "accepted")).collect()
        assert sorted((row.topic, row.arrival_seq) for row in rows) == sorted(
            (topic, seq) for topic, seqs in expected.items() for seq in seqs
        )
        return
    got = {topic: [] for topic in logs}
    for row in spark.read.parquet(str(tmp_path / "out")).collect():
        got[row.topic].append(row.arrival_seq)
    assert {topic: sorted(seqs) for topic, seqs in got.items()} == expected


def test_rows_of_a_hot_key_go_through_the_state_store(spark, tmp_path):
    """Rows of one key come in several pieces; they are wide, and none are put together."""
    import resource

    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    from pyspark.sql import functions as F

    n = 60_000
    rows = spark.range(n).select(
        F.lit("t").alias("topic"), F.lit(0).alias("kafka_partition"),
        # The second half redelivers the first but for its last tenth.
        F.expr(f"if(id < {n // 2}, id, id - {n // 2} + {n // 20})").alias("kafka_offset"), F.col("id").alias("arrival_seq"),
        F.rpad(F.col("id").cast("string"), 200, "x").alias("wide"),
    )
    rows.repartition(6).write.parquet(str(tmp_path / "log"))
    log = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "log"))
    writer = stream_accept(log).writeStream.format("parquet").trigger(availableNow=True)
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start(str(tmp_path / "out")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.count() == n // 2 + n // 20 == kept.select("kafka_offset").distinct().count()
    assert kept.where(f"arrival_seq < {n // 2}").count() == n // 2
    workers = spark.sparkContext.parallelize([0], 1).map(lambda _: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss).first()
    assert workers < 1 << 20
