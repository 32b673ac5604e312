"""Drives a streaming job over stored lines, one micro-batch per ``batch_id``."""

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from clickloom.sources.streams import text_lines
from clickloom.streaming.state import Folder


def replay(spark: SparkSession, lines: DataFrame, pipeline, source: str) -> None:
    """Feed ``lines`` (batch_id, value) to a pipeline in the order of ``batch_id``.

    The lines are read once and dealt out by batch. Each batch then goes to the source
    folder, and the query is started on its checkpoint to process all that is new: a
    batch is thus one micro-batch whatever its number of files, and every batch but the
    first goes through a restart.
    """
    dealt = f"{source}-by-batch"
    lines.select("batch_id", "value").hint("rebalance", "batch_id").write.partitionBy("batch_id").text(dealt)
    names = [x for x in Folder(spark, dealt).names() if x.startswith("batch_id=")]
    with pipeline.hold() if hasattr(pipeline, "hold") else nullcontext():
        for name in sorted(names, key=lambda x: int(x.removeprefix("batch_id="))):
            text_lines_of(spark, f"{dealt}/{name}").write.mode("append").text(source)
            pipeline.start(text_lines(spark, source), availableNow=True).awaitTermination()


def text_lines_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string").text(path)
