"""The record envelope and the topic-log source.

Every operator takes envelope frames, so any source that can supply these columns will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC_PARTITION = ["topic", "kafka_partition"]

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
    ]
)


def from_log_source(messages: DataFrame) -> DataFrame:
    """Rename the columns of Spark's ``kafka`` source to the envelope; keys and values stay nullable bytes."""
    return messages.select(
        F.col("topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("timestamp").alias("ingest_ts"),
    )


def read_topics(
    spark: SparkSession, servers: str, topics: list[str], **options: str
) -> DataFrame:
    """One bounded read of ``topics``; needs Spark's Kafka package on the classpath.

    ``minPartitions`` splits a hot topic-partition over several tasks.
    """
    reader = spark.read.format("kafka").options(**_options(servers, topics, options))
    return from_log_source(reader.load())


def stream_topics(
    spark: SparkSession, servers: str, topics: list[str], **options: str
) -> DataFrame:
    """A stream of ``topics``. ``maxOffsetsPerTrigger`` bounds a micro-batch."""
    reader = spark.readStream.format("kafka").options(**_options(servers, topics, options))
    return from_log_source(reader.load())


def route_counts(records: DataFrame) -> DataFrame:
    """Records delivered to each topic-partition."""
    return records.groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n_records"))


def _options(servers: str, topics: list[str], options: dict[str, str]) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), **options}
