"""The ad-click stream: blacklist, running counts, top ads per area and day, last hour.

Two queries in step. The first, on the log lines, has one ``foreachBatch`` that keeps the
order of effects within a batch: set aside what cannot count, let pass the clicks of users
not listed before this batch, keep the last hour. The second counts what passed
(``streaming.counters``); the first waits for it, so users that reach the threshold in a
batch are listed from the next one on. A batch reads and writes what its clicks touch.

Below the root folder:

    batches/<n>                        what batch n goes by: its limit and the clock before it
    passed/batch=<n>                   the clicks that count, read by the second query
    checkpoint, counters               the queries' checkpoints; the second one's has the counters
    changed                            what the last batch changed, until it is published
    tables/blacklist, area_city_ad_counts, top_area_ads, minutes, last_hour     change logs
    recent/minute=...                  clicks by minute, for the minute at the window's edge
    quarantine/batch_id=...            value, reason
    late/batch_id=...                  clicks of expired dates
    finished/<n>                       the last batch that is whole

A batch is settled by its note in ``batches`` before it has any effect, and its clicks pass
by a rename, once. So a batch that is repeated, whenever and wherever it broke off, does the
same as it would have done, and one that is finished does nothing.

Clock: the latest click's time. A click later than the time of its batch by more than
``ahead_minutes`` is set aside as ``future`` and moves nothing. With ``retain_days`` the
counters of dates before the clock's date less that many days are given up, and later
clicks of such dates go to ``late``; their published results stay as they were. Without it
nothing expires, and a late click counts for its own date.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import ads
from clickloom.operators.joins import join_on, lookup, without
from clickloom.session import configure
from clickloom.streaming.counters import CLICK, USER, Counters
from clickloom.streaming.state import ChangeLog, Folder

MINUTE = 60_000


@dataclass
class AdsPipeline:
    """Settings of the job; ``start`` runs it on a stream of log lines."""

    root: str
    threshold: int = 100
    window_minutes: int = 60
    top_n: int = 3
    retain_days: int | None = None
    ahead_minutes: int = 10
    # Every so many batches the change logs are brought together.
    fold_every: int = 200
    # The time of a batch in milliseconds.
    batch_time: Callable[[], int] = lambda: time.time_ns() // 1_000_000
    _counters: Counters | None = field(default=None, init=False, repr=False)
    _held: bool = field(default=False, init=False, repr=False)

    def __post_init__(self):
        ads.check_window(self.window_minutes)

    def start(self, lines: DataFrame, **trigger) -> StreamingQuery:
        """Run on a streaming frame with a column ``value``.

        Started again with the same root it goes on where it stopped. The default
        trigger is every 5 seconds; ``availableNow=True`` processes what is there. The
        counting query ends with the query returned.
        """
        configure(lines.sparkSession)
        trigger = trigger or {"processingTime": "5 seconds"}
        query = (
            lines.select("value")
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(**trigger)
            .start()
        )
        threading.Thread(target=self._close_after, args=(query,), daemon=True).start()
        return query

    def _close_after(self, query: StreamingQuery) -> None:
        try:
            query.awaitTermination()
        except Exception:  # the caller gets it from the query itself
            pass
        finally:
            if not self._held:
                self.close()

    @contextmanager
    def hold(self) -> Iterator[None]:
        """Keep the counting query running over queries that start and end within."""
        self._held = True
        try:
            yield
        finally:
            self._held = False
            self.close()

    def close(self) -> None:
        """Stop the counting query; the next batch starts it again."""
        counters, self._counters = self._counters, None
        if counters is not None:
            counters.stop()

    def process(self, lines: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch. Running it again changes nothing."""
        spark = lines.sparkSession
        if self._finished(spark)["batch"] >= batch_id:
            return
        note = self._settle(spark, batch_id)
        passed = Folder(spark, f"{self.root}/passed")
        if not passed.exists(f"batch={batch_id}"):
            self._let_pass(lines, note, batch_id)
        clicks = spark.read.schema(CLICK).parquet(f"{passed.path}/batch={batch_id}")
        latest = max((x for x in (note["latest"], clicks.agg(F.max("timestamp")).first()[0]) if x is not None), default=None)
        if latest is not None:
            self._update_last_hour(clicks, spark, batch_id, latest)
        self._counting(spark).catch_up()
        self._finish(spark, batch_id, latest)

    def blacklist(self, spark: SparkSession, last: int | None = None) -> DataFrame:
        """Listed users and the batch that listed them, up to batch ``last``."""
        last = self._finished(spark)["batch"] if last is None else last
        return self._tables(spark).blacklist.read(last)

    def user_ad_counts(self, spark: SparkSession) -> DataFrame:
        """Counted clicks per date, user and ad, from the state of the last finished batch."""
        last = self._finished(spark)["counters"]
        if last < 0:
            return spark.createDataFrame([], "date string, userid string, adid string, clicks long")
        users = self._tables(spark).state(last).where(F.col("kind") == USER)
        return users.select("date", F.col("first").alias("userid"), "adid", "clicks")

    def result(self, spark: SparkSession, name: str) -> DataFrame:
        """``area_city_ad_counts``, ``top_area_ads`` or ``last_hour`` as of the last finished batch."""
        last, tables = self._finished(spark)["batch"], self._tables(spark)
        if name == "area_city_ad_counts":
            return tables.city_ads.read(last).select("area", "city", "adid", "clicks", "date")
        if name == "top_area_ads":
            top = tables.leaders.read(last).select("date", "area", F.inline("top"))
            return ads.top_area_ads_json(top).select("area", "top_ads", "date")
        if name == "last_hour":
            return self._last_hour(spark).read(last)
        raise ValueError(f"no result {name!r}")

    def _tables(self, spark: SparkSession) -> Counters:
        return Counters(spark, self.root, self.threshold, self.top_n, self.retain_days)

    def _counting(self, spark: SparkSession) -> Counters:
        if self._counters is None:
            self._counters = self._tables(spark)
        return self._counters

    def _minutes(self, spark: SparkSession) -> ChangeLog:
        return ChangeLog(spark, f"{self.root}/tables/minutes", "minute long, adid string, clicks long", ["minute", "adid"])

    def _last_hour(self, spark: SparkSession) -> ChangeLog:
        return ChangeLog(spark, f"{self.root}/tables/last_hour", "adid string, minutes string", [])

    def _finished(self, spark: SparkSession) -> dict:
        """The last finished batch, the clock after it and the state that belongs to it."""
        folder = Folder(spark, f"{self.root}/finished")
        last = max(folder.numbers(), default=-1)
        return {"batch": last, **(folder.noted(str(last)) if last >= 0 else {"latest": None, "counters": -1})}

    def _settle(self, spark: SparkSession, batch_id: int) -> dict:
        """Note what the batch goes by, or read what an earlier attempt noted."""
        folder = Folder(spark, f"{self.root}/batches")
        if not folder.exists(str(batch_id)):
            limit = self.batch_time() + self.ahead_minutes * MINUTE
            folder.note(str(batch_id), {"limit": limit, "latest": self._finished(spark)["latest"]})
        return folder.noted(str(batch_id))

    def _expired_before(self, latest: int | None) -> str:
        """The first date that counts."""
        if self.retain_days is None or latest is None:
            return ""
        try:
            return str((datetime(1970, 1, 1) + timedelta(milliseconds=latest, days=-self.retain_days)).date())
        except OverflowError:  # before the year 1
            return ""

    def _let_pass(self, lines: DataFrame, note: dict, batch_id: int) -> None:
        """Set aside what cannot count and write the other clicks for the second query."""
        spark, limit, expired = lines.sparkSession, note["limit"], self._expired_before(note["latest"])
        lines = lines.select("value").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            malformed, future = ads.malformed_ads_log(lines), ads.later_than(lines, limit)
            logs = ads.with_date(ads.parse_ads_log(lines)).where(F.col("timestamp") <= limit)
            aside = malformed.select("value", F.lit("malformed").alias("reason")).unionAll(
                future.select("value", F.lit("future").alias("reason"))
            )
            late = [("late", logs.where(F.col("date") < expired))] if expired else []
            for name, rows in [("quarantine", aside), *late]:
                if not rows.isEmpty():
                    rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")
            tables = self._tables(spark)
            listed = tables.blacklist.read(batch_id - 1).select("userid")
            kept = without(logs.where(F.col("date") >= expired), listed, "userid", tables.listed_bits.read(batch_id - 1))
            staged = f"{self.root}/staged/batch={batch_id}"
            kept.selectExpr(*[f"`{c.split()[0]}`" for c in CLICK.split(", ")]).write.mode("overwrite").parquet(staged)
            Folder(spark, f"{self.root}/passed").move_in(staged, f"batch={batch_id}")
        finally:
            lines.unpersist()

    def _update_last_hour(self, clicks: DataFrame, spark: SparkSession, batch_id: int, latest: int) -> None:
        """Clicks later than the window before the latest click.

        Minutes are summed per ad. Only the minute that the window's edge cuts needs its
        clicks' own times: these are kept by minute, and one minute of them is read.
        """
        edge = latest - self.window_minutes * MINUTE
        first = edge - edge % MINUTE
        start = (F.col("timestamp") - F.pmod("timestamp", F.lit(MINUTE))).alias("minute")
        inside = clicks.where(F.col("timestamp") > edge)
        times = inside.groupBy(start, "adid", "timestamp").agg(F.count("*").alias("clicks"))
        times = times.withColumn("batch", F.lit(batch_id)).hint("rebalance", "minute")
        writer = times.write.mode("overwrite").partitionBy("minute", "batch")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/recent")

        minutes = self._minutes(spark)
        added = inside.groupBy(start, "adid").agg(F.count("*").alias("added"))
        known = lookup(minutes.read(batch_id - 1, F.col("minute") >= first))
        total = F.col("added") + F.coalesce("clicks", F.lit(0))
        minutes.write(join_on(added, known, ["minute", "adid"], "left").withColumn("clicks", total), batch_id)

        whole = minutes.read(batch_id, F.col("minute") > first).withColumnRenamed("minute", "timestamp")
        window = whole.select("adid", "timestamp", "clicks").unionAll(self._edge_minute(spark, first, edge, batch_id))
        counts = ads.ad_minute_counts(window, F.sum("clicks"))
        self._last_hour(spark).write(ads.ad_minutes_json(counts), batch_id)

    def _edge_minute(self, spark: SparkSession, minute: int, edge: int, batch_id: int) -> DataFrame:
        """Clicks (adid, timestamp, clicks) of the minute at the edge that are after it."""
        folder, schema = Folder(spark, f"{self.root}/recent"), "adid string, timestamp long, clicks long, batch long"
        if not folder.exists(f"minute={minute}"):
            return spark.createDataFrame([], "adid string, timestamp long, clicks long")
        rows = spark.read.schema(schema).parquet(f"{folder.path}/minute={minute}")
        rows = rows.where((F.col("timestamp") > edge) & (F.col("batch") <= batch_id))
        return rows.select("adid", "timestamp", "clicks")

    def _finish(self, spark: SparkSession, batch_id: int, latest: int | None) -> None:
        """From here on readers see the batch; then what it replaced may go."""
        tables = self._counting(spark)
        finished = Folder(spark, f"{self.root}/finished")
        finished.note(str(batch_id), {"latest": latest, "counters": tables.last_state()})
        for name, prefix in (("finished", ""), ("batches", ""), ("passed", "batch=")):
            folder = Folder(spark, f"{self.root}/{name}")
            for number in folder.numbers(prefix):
                if number < batch_id:
                    folder.delete(f"{prefix}{number}")
        edge = None if latest is None else latest - self.window_minutes * MINUTE
        if edge is not None:
            recent = Folder(spark, f"{self.root}/recent")
            for name in recent.names():
                if name.startswith("minute=") and int(name.removeprefix("minute=")) < edge - edge % MINUTE:
                    recent.delete(name)
        if (batch_id + 1) % self.fold_every == 0:
            for log in tables.logs:
                log.fold(batch_id)
            self._last_hour(spark).fold(batch_id)
            self._minutes(spark).fold(batch_id, None if edge is None else F.col("minute") >= edge - edge % MINUTE)
