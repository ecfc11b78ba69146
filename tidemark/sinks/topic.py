"""Publishing metric messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.topic import DEFAULT_TOPIC

# Delivery settings of the publisher.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.compression.type": "gzip"}


def write_topic(messages: DataFrame, servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Send ``key``/``value`` rows to a topic. Needs the Spark Kafka connector on the class path."""
    writer = messages.select("key", "value").write.format("kafka")
    for key, value in PRODUCER_OPTIONS.items():
        writer = writer.option(key, value)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_message_files(messages: DataFrame, path: str) -> None:
    """The same messages as gzip text files, one JSON text per line."""
    messages.select("value").write.mode("append").option("compression", "gzip").text(path)
