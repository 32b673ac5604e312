"""Ad clicks: parsing, blacklisting, running counts, top ads, last hour.

A log row has the columns of ``schemas.ADS_LOG``. The replay operators also need
``batch_id``, the number of the micro-batch in which the row arrives.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import event_date, event_minute, json_pairs
from clickloom.operators.joins import is_small, key_bits, split_by_bits
from clickloom.operators.ranking import top_rows

LOG_FIELDS = ["timestamp", "area", "city", "userid", "adid"]
# Timestamps outside the years 1 to 9999 have no yyyy-MM-dd date.
MILLIS_RANGE = (-62135596800000, 253402300799999)
USER_AD = ["date", "userid", "adid"]
AREA_CITY_AD = ["date", "area", "city", "adid"]


# A number and at least four more fields, where trailing spaces do not make fields.
LINE_PATTERN = "(?s)^[+-]?[0-9]+( [^ ]*){3} .*[^ ]"


def _millis(line: Column) -> Column:
    return F.substring_index(line, " ", 1).try_cast("bigint")


def _is_well_formed(line: Column) -> Column:
    in_range = F.coalesce(_millis(line).between(*MILLIS_RANGE), F.lit(False))
    return F.coalesce(line.rlike(LINE_PATTERN) & in_range, F.lit(False))


def parse_ads_log(lines: DataFrame) -> DataFrame:
    """Well-formed lines ``millis area city userid adid``; further fields are ignored.

    Other columns of ``lines`` are kept.
    """
    line = F.col("value")
    others = [c for c in lines.columns if c != "value"]
    split = lines.where(_is_well_formed(line)).select(
        *others, _millis(line).alias("timestamp"), F.split(line, " ").alias("_part")
    )
    return split.select(
        *others, "timestamp", *[F.get("_part", F.lit(i)).alias(LOG_FIELDS[i]) for i in range(1, len(LOG_FIELDS))]
    )


def malformed_ads_log(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_ads_log`` leaves out."""
    return lines.where(~_is_well_formed(F.col("value")))


def later_than(lines: DataFrame, limit: int) -> DataFrame:
    """The well-formed lines with a time after ``limit``."""
    return lines.where(_is_well_formed(F.col("value")) & (_millis(F.col("value")) > limit))


def event_hour(millis: Column) -> Column:
    """``yyyy-MM-dd-HH`` of a time in milliseconds."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd-HH")


def check_window(minutes: int) -> None:
    """A minute of day names one minute only, so a window is a day at most."""
    if not 0 < minutes <= 24 * 60:
        raise ValueError("the window must be longer than 0 and at most 24 hours")


def with_date(logs: DataFrame) -> DataFrame:
    return logs.withColumn("date", event_date(F.col("timestamp")))


def batch_user_ad_counts(logs: DataFrame, *more: Column) -> DataFrame:
    """Clicks per batch, date, user and ad, with the total up to that batch.

    ``more`` are further aggregates of the same groups.
    """
    per_batch = with_date(logs).groupBy("batch_id", *USER_AD).agg(F.count("*").alias("clicks"), *more)
    so_far = Window.partitionBy(*USER_AD).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return per_batch.withColumn("running_clicks", F.sum("clicks").over(so_far))


def replay_blacklist(logs: DataFrame, threshold: int = 100) -> DataFrame:
    """Users that reach ``threshold`` clicks on one ad in one day, and in which batch.

    A user's clicks all count until the user is listed, so the totals of all clicks
    give the batch of listing; no step-by-step simulation is needed.
    """
    return blacklist_of(batch_user_ad_counts(logs), threshold)


def blacklist_of(counts: DataFrame, threshold: int = 100) -> DataFrame:
    """The same from the counts of ``batch_user_ad_counts``."""
    reached = counts.where(F.col("running_clicks") >= threshold)
    return reached.groupBy("userid").agg(F.min("batch_id").alias("listed_batch"))


def drop_blacklisted(logs: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Logs without those that arrive after the batch in which their user was listed.

    Of a blacklist too large to broadcast a bitmap picks the logs that need be compared; the
    logs of other users are not shuffled.
    """
    if is_small(blacklist):
        return _not_after_listing(logs, F.broadcast(blacklist))
    may, rest = split_by_bits(logs, "userid", key_bits(blacklist, "userid"))
    return _not_after_listing(may, blacklist).select(*logs.columns).unionAll(rest.select(*logs.columns))


def _not_after_listing(logs: DataFrame, blacklist: DataFrame) -> DataFrame:
    return (
        logs.join(blacklist, "userid", "left")
        .where(F.col("listed_batch").isNull() | (F.col("batch_id") <= F.col("listed_batch")))
        .select(*logs.columns)
    )


def user_ad_counts(logs: DataFrame) -> DataFrame:
    """Clicks per date, user and ad."""
    return with_date(logs).groupBy(*USER_AD).agg(F.count("*").alias("clicks"))


def area_city_ad_counts(logs: DataFrame) -> DataFrame:
    """Clicks per date, area, city and ad."""
    return with_date(logs).groupBy(*AREA_CITY_AD).agg(F.count("*").alias("clicks"))


def area_ad_counts(city_counts: DataFrame) -> DataFrame:
    """Clicks per date, area and ad from the counts per city."""
    return city_counts.groupBy("date", "area", "adid").agg(F.sum("clicks").alias("clicks"))


def top_area_ads(ad_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads per date and area; ties go to the smaller adid."""
    return top_rows(ad_counts, ["date", "area"], [F.desc("clicks"), F.asc("adid")], n)


def top_area_ads_json(top: DataFrame) -> DataFrame:
    """Per date and area ``[{"ad":clicks},...]`` in the order of the ranking."""
    return top.groupBy("date", "area").agg(
        json_pairs(F.col("adid"), F.col("clicks"), F.col("position")).alias("top_ads")
    )


def recent_clicks(
    logs: DataFrame, blacklist: DataFrame, minutes: int = 60, latest: DataFrame | None = None
) -> DataFrame:
    """Logs that pass the blacklist and are later than ``minutes`` before the latest such.

    ``latest`` has the time of the latest click for each batch and user (``latest_clicks``)
    where that is known already. Older logs are dropped before they are joined.
    """
    check_window(minutes)
    latest = latest_clicks(logs) if latest is None else latest
    edge = drop_blacklisted(latest, blacklist).agg(F.max("timestamp") - F.lit(minutes * 60_000))
    return drop_blacklisted(logs.where(F.col("timestamp") > edge.scalar()), blacklist)


def latest_clicks(logs: DataFrame) -> DataFrame:
    """The time of the latest click of each batch and user."""
    return logs.groupBy("batch_id", "userid").agg(F.max("timestamp").alias("timestamp"))


def ad_minute_counts(logs: DataFrame, count=None) -> DataFrame:
    """Clicks per ad and minute of day.

    ``count`` is the aggregate to use where the rows are counted already.
    """
    count = F.count("*") if count is None else count
    return logs.groupBy("adid", event_minute(F.col("timestamp")).alias("minute")).agg(count.alias("clicks"))


def ad_minutes_json(minute_counts: DataFrame) -> DataFrame:
    """Per ad ``[{"HH:mm":clicks},...]`` by minute."""
    return minute_counts.groupBy("adid").agg(
        json_pairs(F.col("minute"), F.col("clicks"), F.col("minute")).alias("minutes")
    )
