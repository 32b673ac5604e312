"""Every operator as a query over the test tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import composite_key
from clickloom.operators import actions as act
from clickloom.operators import ads, area, category, funnel, words
from clickloom.plans import jobs
from clickloom.schemas import TABLES
from clickloom.session import configure, new_shared_dir, store
from clickloom.sinks.tables import replace_table
from clickloom.sources import testdata as td
from clickloom.sources.params import JobParams
from clickloom.sources.tables import read_table
from clickloom.streaming.ads import AdsPipeline
from clickloom.streaming.replay import replay
from clickloom.streaming.words import WordCountPipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PARAMS = JobParams.from_mapping(td.PARAMS)
# Days per micro-batch in the streaming queries; the batch forms replay single days.
STREAM_BATCH_DAYS = 10


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# Area and product


def _city_counts(spark, sf_dir):
    return area.city_product_counts(
        td.user_visit_action(spark, sf_dir), td.city_info(spark, sf_dir), td.product_info(spark, sf_dir)
    )


def _star_city_counts(spark, sf_dir):
    return area.city_product_counts(
        td.star_actions(spark, sf_dir), td.city_info(spark, sf_dir), td.product_info(spark, sf_dir)
    )


@query
def area_product_counts(spark, sf_dir):
    return area.area_product_counts(_city_counts(spark, sf_dir))


@query
def city_click_ratio(spark, sf_dir):
    return area.city_click_ratio(_city_counts(spark, sf_dir))


@query
def area_product_top3(spark, sf_dir):
    return area.area_product_top(_city_counts(spark, sf_dir))


@query
def star_area_product_top3(spark, sf_dir):
    return area.area_product_top(_star_city_counts(spark, sf_dir))


@query
def star_city_click_ratio(spark, sf_dir):
    return area.city_click_ratio(_star_city_counts(spark, sf_dir))


# Categories


def _selected(spark, sf_dir):
    return act.select_actions(td.user_visit_action(spark, sf_dir), td.user_info(spark, sf_dir), PARAMS)


@query
def session_filtered_actions(spark, sf_dir):
    return _selected(spark, sf_dir)


@query
def category_action_counts(spark, sf_dir):
    return category.category_action_counts(_selected(spark, sf_dir))


@query
def category_top10(spark, sf_dir):
    return category.top_categories(category.category_action_counts(_selected(spark, sf_dir)))


@query
def category_session_counts(spark, sf_dir):
    return category.session_clicks(_selected(spark, sf_dir))


@query
def category_session_top10(spark, sf_dir):
    counts = store(category.category_session_actions(_selected(spark, sf_dir)), "category-sessions")
    top = category.top_categories(category.counts_of_categories(counts))
    return category.top_category_sessions(category.clicks_of_sessions(counts), top)


def _as_table(spark, frame, name, **layout):
    """The input table ``name`` written to the catalog with a layout, and read from there."""
    table = f"{name}_{uuid.uuid4().hex}"
    replace_table(frame.select(*TABLES[name].names), table, path=new_shared_dir(spark, name), **layout)
    return read_table(spark, name, table=table)


@query
def date_partitioned_category_counts(spark, sf_dir):
    # A folder for each date: the range of dates leaves the other folders unread.
    actions = _as_table(spark, td.user_visit_action(spark, sf_dir), "user_visit_action", partition_by=["date"])
    return category.category_action_counts(act.select_actions(actions, td.user_info(spark, sf_dir), PARAMS))


@query
def user_bucketed_category_counts(spark, sf_dir):
    # Both sides dealt by user: where the users are not broadcast they meet without a shuffle.
    layout = {"bucket_by": ["user_id"], "buckets": 8}
    actions = _as_table(spark, td.user_visit_action(spark, sf_dir), "user_visit_action", **layout)
    users = _as_table(spark, td.user_info(spark, sf_dir), "user_info", **layout)
    return category.category_action_counts(act.select_actions(actions, users, PARAMS))


# Page flow


@query
def page_view_counts(spark, sf_dir):
    return funnel.page_views(td.user_visit_action(spark, sf_dir), funnel.flow_pages(PARAMS.page_flow))


@query
def page_jump_counts(spark, sf_dir):
    return funnel.page_jumps(
        td.user_visit_action(spark, sf_dir), funnel.flow_pairs(PARAMS.page_flow), td.ACTION_ORDER
    )


@query
def page_jump_counts_sliced(spark, sf_dir):
    # The form for large data: sessions cut by their rows.
    return funnel.page_jumps(
        td.user_visit_action(spark, sf_dir), funnel.flow_pairs(PARAMS.page_flow), td.ACTION_ORDER, whole_below=0
    )


@query
def page_jump_ratio(spark, sf_dir):
    return funnel.page_jump_ratio(
        td.user_visit_action(spark, sf_dir), PARAMS.page_flow, order_by=td.ACTION_ORDER
    )


@query
def page_jump_ratio_reversed(spark, sf_dir):
    return funnel.page_jump_ratio(
        td.user_visit_action(spark, sf_dir), PARAMS.page_flow, reverse=True, order_by=td.ACTION_ORDER
    )


# Jobs: what they hand to their writer, without the task id of the run


def _written(job, *args, result: str, **options):
    found = {}
    job(*args, lambda df, name: found.update({name: df.drop("task_id")}), **options)
    return found[result]


@query
def job_category_top10(spark, sf_dir):
    actions, users = td.user_visit_action(spark, sf_dir), td.user_info(spark, sf_dir)
    return _written(jobs.category_job, actions, users, PARAMS, result="category_top10")


@query
def job_category_session_top10(spark, sf_dir):
    actions, users = td.user_visit_action(spark, sf_dir), td.user_info(spark, sf_dir)
    return _written(jobs.category_job, actions, users, PARAMS, result="category_session_top10")


@query
def job_page_jump_ratio(spark, sf_dir):
    actions = td.user_visit_action(spark, sf_dir)
    return _written(jobs.page_jump_job, actions, PARAMS, result="jump_page_ratio", order_by=td.ACTION_ORDER)


@query
def job_area_count_info(spark, sf_dir):
    actions = td.user_visit_action(spark, sf_dir)
    dimensions = td.city_info(spark, sf_dir), td.product_info(spark, sf_dir)
    return _written(jobs.area_job, actions, *dimensions, result="area_count_info")


# Ads


def _logs(spark, sf_dir):
    return ads.parse_ads_log(td.ads_log_lines(spark, sf_dir).select("batch_id", "value"))


def _blacklist(logs):
    # Stored: its size then decides whether the logs have to be shuffled to meet it.
    return store(ads.replay_blacklist(logs, td.BLACKLIST_THRESHOLD), "blacklist")


def _kept_logs(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    return ads.drop_blacklisted(logs, _blacklist(logs))


def _city_ad_counts(spark, sf_dir):
    return ads.area_city_ad_counts(_kept_logs(spark, sf_dir))


@query
def ads_log_parsed(spark, sf_dir):
    return ads.with_date(ads.parse_ads_log(td.ads_log_lines(spark, sf_dir).select("value")))


@query
def ads_log_quarantine(spark, sf_dir):
    # The lines of `error` events lose their last field.
    cut = F.when(F.col("event_type") == "error", F.regexp_replace("value", " [^ ]*$", "")).otherwise(F.col("value"))
    return ads.malformed_ads_log(td.ads_log_lines(spark, sf_dir).select(cut.alias("value")))


@query
def date_user_ad_batch_counts(spark, sf_dir):
    return ads.batch_user_ad_counts(_logs(spark, sf_dir))


@query
def ad_blacklist(spark, sf_dir):
    return ads.replay_blacklist(_logs(spark, sf_dir), td.BLACKLIST_THRESHOLD)


@query
def ads_after_blacklist(spark, sf_dir):
    return _kept_logs(spark, sf_dir)


@query
def date_user_ad_counts(spark, sf_dir):
    return ads.user_ad_counts(_kept_logs(spark, sf_dir))


@query
def date_area_city_ad_counts(spark, sf_dir):
    return _city_ad_counts(spark, sf_dir)


@query
def date_area_city_ad_keys(spark, sf_dir):
    # The counts under one composite key per date, as a hash of a key-value store has them.
    key = composite_key("area", "city", "adid").alias("field")
    return _city_ad_counts(spark, sf_dir).select("date", key, F.col("clicks").cast("string").alias("value"))


@query
def date_area_ad_counts(spark, sf_dir):
    return ads.area_ad_counts(_city_ad_counts(spark, sf_dir))


@query
def top3_ads_per_area_day(spark, sf_dir):
    return ads.top_area_ads(ads.area_ad_counts(_city_ad_counts(spark, sf_dir)))


@query
def top3_ads_per_area_day_json(spark, sf_dir):
    return ads.top_area_ads_json(ads.top_area_ads(ads.area_ad_counts(_city_ad_counts(spark, sf_dir))))


def _last_hour(spark, sf_dir):
    # One pass over the raw log gives the blacklist and the window's edge, a second the clicks.
    logs = _logs(spark, sf_dir)
    counts = store(ads.batch_user_ad_counts(logs, F.max("timestamp").alias("timestamp")), "user-ad-counts")
    blacklist = store(ads.blacklist_of(counts, td.BLACKLIST_THRESHOLD), "blacklist")
    return ads.ad_minute_counts(
        ads.recent_clicks(logs, blacklist, td.WINDOW_MINUTES, ads.latest_clicks(counts))
    )


@query
def last_hour_ad_minutes(spark, sf_dir):
    return _last_hour(spark, sf_dir)


@query
def last_hour_ad_minutes_json(spark, sf_dir):
    return ads.ad_minutes_json(_last_hour(spark, sf_dir))


@query
def word_count(spark, sf_dir):
    return words.word_count(td.document_lines(spark, sf_dir))


# Streams: the same lines replayed in micro-batches


def _run_ads_stream(spark, sf_dir) -> AdsPipeline:
    root = new_shared_dir(spark, "ads-stream")
    pipeline = AdsPipeline(f"{root}/job", td.BLACKLIST_THRESHOLD, td.WINDOW_MINUTES)
    lines = td.ads_log_lines(spark, sf_dir, STREAM_BATCH_DAYS)
    replay(spark, lines, pipeline, f"{root}/lines")
    return pipeline


@query
def stream_ads_pipeline_counts(spark, sf_dir):
    return _run_ads_stream(spark, sf_dir).result(spark, "area_city_ad_counts")


@query
def stream_user_ad_counts(spark, sf_dir):
    return _run_ads_stream(spark, sf_dir).user_ad_counts(spark)


@query
def stream_ad_blacklist(spark, sf_dir):
    return _run_ads_stream(spark, sf_dir).blacklist(spark)


@query
def stream_top3_ads(spark, sf_dir):
    return _run_ads_stream(spark, sf_dir).result(spark, "top_area_ads")


@query
def stream_last_hour_ads(spark, sf_dir):
    return _run_ads_stream(spark, sf_dir).result(spark, "last_hour")


@query
def stream_late_and_future_clicks(spark, sf_dir):
    """Every batch has clicks of all dates; those of `error` events lie a century ahead."""
    millis = F.regexp_extract("value", "^[0-9]+", 0).cast("long")
    ahead = F.concat(millis + 36_500 * td.MILLIS_PER_DAY, F.regexp_extract("value", " .*", 0))
    user = F.element_at(F.split("value", " "), -2).cast("long")
    lines = td.ads_log_lines(spark, sf_dir).select(
        (user % 3).alias("batch_id"),
        F.when(F.col("event_type") == "error", ahead).otherwise(F.col("value")).alias("value"),
    )
    root = new_shared_dir(spark, "ads-stream")
    pipeline = AdsPipeline(f"{root}/job", td.BLACKLIST_THRESHOLD, td.WINDOW_MINUTES)
    replay(spark, lines, pipeline, f"{root}/lines")
    return pipeline.result(spark, "area_city_ad_counts")


@query
def stream_word_count(spark, sf_dir):
    root = new_shared_dir(spark, "word-stream")
    pipeline = WordCountPipeline(f"{root}/job")
    lines = td.document_lines(spark, sf_dir).select((F.col("doc_id") % 3).alias("batch_id"), "value")
    replay(spark, lines, pipeline, f"{root}/lines")
    return pipeline.result(spark)
