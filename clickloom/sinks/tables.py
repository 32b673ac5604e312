"""Batch writers. Failures propagate to the caller."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, task_id: str) -> DataFrame:
    """Put one task id in front of every row of a run."""
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 200,
    path: str | None = None,
) -> None:
    """Write a catalog table, replacing what it held; at ``path``, or where the catalog puts it.

    ``partition_by`` gives a folder to each value, which a filter on it can pass over.
    ``bucket_by`` deals the rows into sorted buckets, one file each (of each partition):
    tables bucketed alike meet in a join on those columns without a shuffle.
    """
    if bucket_by:
        # The writer's buckets are those of a hash repartition: a task writes whole buckets.
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def jdbc_options(
    url: str, table: str, batch_size: int = 10_000, connections: int = 10, **properties: str
) -> dict[str, str]:
    """Options of Spark's JDBC writer; ``connections`` bounds the load on the database."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **properties,
    }


def append_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    """Append to a database table from the executors, in batches; nothing is collected."""
    df.write.format("jdbc").options(**options).mode("append").save()
