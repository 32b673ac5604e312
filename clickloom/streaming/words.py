"""Running word count: a stateful streaming aggregation."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.words import word_count
from clickloom.session import configure


@dataclass
class WordCountPipeline:
    """Keeps the count of every word in Spark's state store below ``root``.

    Nothing else stores the counts: ``result`` reads the state of the last finished batch,
    and ``publish(changed, batch_id)``, if given, gets the words that a batch changed.
    """

    root: str
    publish: Callable[[DataFrame, int], None] | None = None

    def start(self, lines: DataFrame, **trigger) -> StreamingQuery:
        configure(lines.sparkSession)
        trigger = trigger or {"processingTime": "5 seconds"}
        counts = word_count(lines).writeStream.outputMode("update")
        counts = counts.foreachBatch(self.publish) if self.publish else counts.format("noop")
        return counts.option("checkpointLocation", f"{self.root}/checkpoint").trigger(**trigger).start()

    def result(self, spark: SparkSession) -> DataFrame:
        state = configure(spark).read.format("statestore").load(f"{self.root}/checkpoint")
        return state.select("key.word", "value.count").withColumnRenamed("count", "n")
