"""Topic-shaped frames: ``(key, value bytes, topic, ...)`` as a log source gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def decode_topic(records: DataFrame, topics: list[str]) -> DataFrame:
    """Text values of the subscribed topics; works on batch and streaming frames."""
    return records.filter(F.col("topic").isin(*topics)).select(
        "topic", F.col("value").cast("string").alias("value")
    )


def read_topics(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest") -> DataFrame:
    """Stream from a broker; needs Spark's Kafka package on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
    )
    return decode_topic(stream, topics)
