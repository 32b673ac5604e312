"""Streaming readers. Each yields the lines in a string column ``value``."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | dict = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``starting_offsets`` is "earliest", "latest" or {topic: {partition: offset}}; it
    only matters for a query without a checkpoint. ``min_partitions`` splits the
    offset range of a hot Kafka partition over several tasks.
    """
    if isinstance(starting_offsets, dict):
        starting_offsets = json.dumps(
            {t: {str(p): int(o) for p, o in parts.items()} for t, parts in starting_offsets.items()}
        )
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.group.id": group_id,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def kafka_lines(spark: SparkSession, servers: str, topic: str, field: str = "value", **settings) -> DataFrame:
    """Message values (or keys) of a topic. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **settings))
    return message_lines(reader.load(), field)


def message_lines(messages: DataFrame, field: str = "value") -> DataFrame:
    """The text of the values (or keys) of Kafka messages; null where a message has none."""
    if field not in ("value", "key"):
        raise ValueError("field is 'value' or 'key'")
    return messages.select(F.col(field).cast("string").alias("value"))


def text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. Spark cannot replay them: not for jobs that must survive a restart."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
