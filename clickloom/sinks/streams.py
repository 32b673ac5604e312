"""Streaming sinks."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def to_console(stream: DataFrame, output_mode: str = "append", **trigger) -> StreamingQuery:
    """Print each batch, e.g. ``to_console(lines, processingTime="3 seconds")``."""
    trigger = trigger or {"processingTime": "5 seconds"}
    return stream.writeStream.format("console").outputMode(output_mode).trigger(**trigger).start()
