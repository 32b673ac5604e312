"""Word count."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """The words of each line: cut at single spaces, without empty ones."""
    return lines.select(F.explode(F.split(column, " ")).alias("word")).where(F.col("word") != "")


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each word; works on batch and streaming input alike."""
    return line_words(lines, column).groupBy("word").agg(F.count("*").alias("n"))
