"""Message streams: a Kafka topic, or landed message files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TOPIC = "microplastics-metrics"


def read_topic(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC, starting: str = "latest", **options: str) -> DataFrame:
    """Subscribe to a topic. Needs the Spark Kafka connector on the class path.

    Returns ``value`` (text), ``arrival`` and ``seq``; the offset orders the messages of
    a partition, and messages of one type share a partition through their key.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival"), F.col("offset").alias("seq")
    )


def read_message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over message files, one JSON text per line, with the columns of :func:`read_topic`.

    Lines of a file have no position in Spark, so ``seq`` is a hash of the text: it only
    makes the order of messages with equal times repeatable.
    """
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("arrival"),
        F.xxhash64("value").alias("seq"),
    )
