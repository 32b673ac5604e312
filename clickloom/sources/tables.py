"""Batch readers of the four input tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import TABLES


def read_table(spark: SparkSession, name: str, path: str | None = None, table: str | None = None) -> DataFrame:
    """An input table with its fixed columns and types, from the catalog (under its own name
    or as ``table``) or from parquet.

    Only the declared columns are selected, and Spark prunes further to those a job uses.
    """
    schema = TABLES[name]
    if path is not None:
        return spark.read.schema(schema).parquet(path)
    frame = spark.table(table or name)
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def from_rows(spark: SparkSession, name: str, rows: list) -> DataFrame:
    """An input table from rows at hand, for tests and small imports."""
    return spark.createDataFrame(rows, TABLES[name])
