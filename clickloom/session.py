"""Session settings the jobs rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only; memory, cores and spark.sql.shuffle.partitions stay
# with whoever starts the session.
SETTINGS = {
    # Dates and minutes are rendered in the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Broadcast joins are chosen by measured size, small shuffle partitions are
    # merged, and the partition of a hot join key is split over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk with incremental checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def new_shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a session without that setting (a local test) gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="clickloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the files.

    It is then computed once however often it is used, survives the loss of executors,
    and Spark knows its size when it plans the joins that follow.
    """
    path = new_shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
