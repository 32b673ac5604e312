"""Times the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each batch query runs once to warm up and then three times, and the median counts;
a streaming query, which replays its input through several restarts, runs once.
The text operators are measured by their own check, not here. At the end, many small
micro-batches go through the ad stream; the times of the second and the last are printed.
Results go to Spark's noop sink: every row is computed, none is collected.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from clickloom.plans.queries import QUERIES
from clickloom.streaming.ads import AdsPipeline

RUNS = 3


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def batch_seconds(spark, root: str, batches: int = 50, counters: int = 1_000_000) -> dict[str, float]:
    """Seconds of the second and the last of many small micro-batches of one day that has
    ``counters`` counters of users and ads."""
    pipeline = AdsPipeline(root, threshold=10**6)
    day = spark.range(counters).selectExpr(
        f"concat({1_700_000_000_000}, ' N c', id % 1000, ' v', id div 6, ' ', id % 6) as value"
    )
    pipeline.process(day, 0)
    timings = {}
    for number in range(1, batches + 1):
        clicks = spark.range(200).selectExpr(
            f"concat({1_700_000_000_000 + number * 5000} + id, ' N c u', id % 40, ' ', id % 6) as value"
        )
        start = time.perf_counter()
        pipeline.process(clicks, number)
        timings[str(number)] = round(time.perf_counter() - start, 3)
    pipeline.close()
    return {number: timings[number] for number in ("2", str(batches))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, query in QUERIES.items():
        if not name.startswith("stream_"):
            seconds(query, spark, sf_dir)
            timings[name] = statistics.median(seconds(query, spark, sf_dir) for _ in range(RUNS))
        else:
            timings[name] = seconds(query, spark, sf_dir)
    stream_batches = batch_seconds(spark, f"{spark.conf.get('spark.checkpoint.dir')}/batches")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all queries (median of warm runs; streams once)",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "seconds_of_stream_batch": stream_batches,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
