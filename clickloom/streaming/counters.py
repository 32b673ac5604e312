"""The running counters of the ad stream, kept by Spark's own streaming aggregation.

A second query reads the clicks that the first has let pass, one folder per batch of the
first, and counts them per date and user and ad, city and ad, area and ad. The counters live
in the state store (RocksDB), so that a batch costs what its clicks touch, whatever else
there is; ``update`` mode hands on the changed counters, and those alone are published:

- users whose counter reached the threshold join the blacklist;
- changed city counts go to a change log;
- the top ads of the areas that changed are ranked again. Counters only grow, so an ad that
  did not change can only be among the leaders if it was before: the old leaders and the
  changed counters are all that is looked at.

With ``retain_days`` a watermark on the dates removes the counters of dates given up.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import ads
from clickloom.operators.joins import key_bits
from clickloom.streaming.state import ChangeLog, Folder

CLICK = "timestamp long, area string, city string, userid string, adid string, date string"
CHANGED = "date string, kind string, first string, second string, adid string, clicks long, batch long"
USER, CITY, AREA = "user", "city", "area"
TOP = "array<struct<position: int, adid: string, clicks: long>>"
DAY = 86_400_000


def counted(clicks: DataFrame, retain_days: int | None) -> DataFrame:
    """Running (day, kind, first, second, adid, clicks, batch) of a stream of ``CLICK`` rows
    with their batch; a day is named by its last millisecond."""
    none = F.lit(None).cast("string")

    def key(kind: str, first: Column, second: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), first.alias("first"), second.alias("second"))

    kinds = [key(USER, F.col("userid"), none), key(CITY, F.col("area"), F.col("city")), key(AREA, F.col("area"), none)]
    millis = F.col("timestamp") - F.pmod("timestamp", F.lit(DAY)) + (DAY - 1)
    rows = clicks.select(F.timestamp_millis(millis).alias("day"), F.explode(F.array(*kinds)).alias("k"), "adid", "batch")
    if retain_days is not None:
        # A day goes when a later click lies more than so many days ahead.
        rows = rows.withWatermark("day", f"{retain_days * DAY + 1} milliseconds")
    rows = rows.select("day", "k.*", "adid", "batch")
    counters = rows.groupBy("day", "kind", "first", "second", "adid")
    return counters.agg(F.count("*").alias("clicks"), F.max("batch").alias("batch"))


class Counters:
    """The counting query below ``root``, and the tables it publishes."""

    def __init__(self, spark: SparkSession, root: str, threshold: int, top_n: int, retain_days: int | None):
        self.spark, self.root, self.threshold, self.top_n, self.retain_days = spark, root, threshold, top_n, retain_days
        tables = f"{root}/tables"
        self.blacklist = ChangeLog(spark, f"{tables}/blacklist", "userid string, listed_batch long", ["userid"])
        self.listed_bits = ChangeLog(spark, f"{tables}/listed_bits", "slot long, bits binary", ["slot"])
        self.city_ads = ChangeLog(
            spark,
            f"{tables}/area_city_ad_counts",
            "date string, area string, city string, adid string, clicks long",
            ["date", "area", "city", "adid"],
        )
        self.leaders = ChangeLog(
            spark, f"{tables}/top_area_ads", f"date string, area string, top {TOP}", ["date", "area"]
        )
        self.logs = [self.blacklist, self.listed_bits, self.city_ads, self.leaders]
        self.query: StreamingQuery | None = None

    def catch_up(self) -> None:
        """Count and publish all clicks let pass so far. They are those of one batch: the
        next one waits for this."""
        if self.query is None or not self.query.isActive:
            self.query = self._start()
        self.query.processAllAvailable()

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None

    def last_state(self) -> int:
        """The counting query's last committed batch, -1 before the first."""
        return max(Folder(self.spark, f"{self.root}/counters/commits").numbers(), default=-1)

    def state(self, last: int) -> DataFrame:
        """The counters after batch ``last`` of the counting query."""
        reader = self.spark.read.format("statestore").option("batchId", last)
        rows = reader.load(f"{self.root}/counters")
        return rows.select(_date("key.day"), "key.kind", "key.first", "key.second", "key.adid", F.col("value.count").alias("clicks"))

    def _start(self) -> StreamingQuery:
        passed = Folder(self.spark, f"{self.root}/passed")
        passed.make()
        clicks = self.spark.readStream.schema(f"{CLICK}, batch long").parquet(passed.path)
        return (
            counted(clicks, self.retain_days)
            .writeStream.outputMode("update")
            .foreachBatch(self.publish)
            .option("checkpointLocation", f"{self.root}/counters")
            .trigger(processingTime="100 milliseconds")
            .start()
        )

    def publish(self, changed: DataFrame, _: int) -> None:
        """Publish the changed counters under the number of the batch that changed them."""
        reached = (F.col("kind") == USER) & (F.col("clicks") >= self.threshold)
        changed = changed.select(_date("day"), "kind", "first", "second", "adid", "clicks", "batch")
        # The counting is done by this one write. The steps below use their rows several times,
        # and a frame that meets itself in a join is computed again, cached or not. Of the
        # users only the listed ones go on; every click also has an area, whose row names the batch.
        path = f"{self.root}/changed"
        changed.where((F.col("kind") != USER) | reached).write.mode("overwrite").parquet(path)
        changed = changed.sparkSession.read.schema(CHANGED).parquet(path)
        seen = changed.agg(F.max("batch").alias("batch"), F.count_if(reached).alias("reached")).first()
        batch = seen.batch
        if batch is None:
            return
        cities = changed.where(F.col("kind") == CITY).select(
            "date", F.col("first").alias("area"), F.col("second").alias("city"), "adid", "clicks"
        )
        areas = changed.where(F.col("kind") == AREA).select("date", F.col("first").alias("area"), "adid", "clicks")
        steps = [lambda: self.city_ads.write(cities, batch), lambda: self._rank(areas, batch)]
        if seen.reached:
            listed = changed.where(reached).select(F.col("first").alias("userid")).distinct()
            steps.append(lambda: self._list(listed, batch))
        # Small outputs that do not read each other. Their jobs belong to the query's job
        # group, so that stopping it stops them.
        with ThreadPoolExecutor(len(steps)) as pool:
            done = [pool.submit(inheritable_thread_target(changed.sparkSession)(step)) for step in steps]
        for output in done:
            output.result()

    def _list(self, users: DataFrame, batch: int) -> None:
        """Put users on the blacklist and set their bits; see ``operators.joins``."""
        self.blacklist.write(users.withColumn("listed_batch", F.lit(batch).cast("long")), batch)
        marks = key_bits(users, "userid")
        known = self.listed_bits.read(batch - 1).join(marks.select("slot"), "slot", "left_semi")
        both = known.unionByName(marks).groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        self.listed_bits.write(both, batch)

    def _rank(self, areas: DataFrame, batch: int) -> None:
        touched = areas.select("date", "area").distinct()
        before = self.leaders.read(batch - 1).join(touched, ["date", "area"], "left_semi")
        before = before.select("date", "area", F.inline("top")).select("date", "area", "adid", "clicks")
        # An old leader that changed is there twice; its greater count is the new one.
        candidates = areas.unionByName(before).groupBy("date", "area", "adid").agg(F.max("clicks").alias("clicks"))
        best = ads.top_area_ads(candidates, self.top_n)
        entry = F.struct(F.col("position").cast("int").alias("position"), "adid", "clicks")
        self.leaders.write(best.groupBy("date", "area").agg(F.array_sort(F.collect_list(entry)).alias("top")), batch)


def _date(day: str) -> Column:
    return F.col(day).cast("date").cast("string").alias("date")
