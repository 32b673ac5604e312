"""What the plans must look like at scale."""

import re

import pytest
from helpers import actions, rows

from clickloom.operators import ads, category, funnel, joins, ranking
from clickloom.operators.actions import select_actions
from clickloom.operators.joins import lookup
from clickloom.plans import jobs, queries
from clickloom.plans.queries import QUERIES
from clickloom.sinks.tables import replace_table, write_parquet
from clickloom.sources.params import JobParams
from clickloom.sources.tables import from_rows, read_table

SF_DIR = "/root/testdata/sf0.001"
BATCH = {name: query for name, query in QUERIES.items() if not name.startswith("stream_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_stays_in_the_jvm_without_cross_joins(spark, name):
    text = plan(BATCH[name](spark, SF_DIR))
    for operator in ("Python", "ArrowEval", "MapInPandas", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in text


@pytest.mark.parametrize(
    "name",
    ["area_product_top3", "star_area_product_top3", "category_session_top10", "top3_ads_per_area_day"],
)
def test_groups_are_cut_before_the_shuffle(spark, monkeypatch, name):
    # The floors of the area report are stored before the report is planned.
    seen = []
    kept = ranking.store
    monkeypatch.setattr(ranking, "store", lambda df, name: seen.append(plan(df)) or kept(df, name))
    seen.append(plan(BATCH[name](spark, SF_DIR)))
    assert re.search(r"WindowGroupLimit.*Partial", "".join(seen))


@pytest.mark.parametrize("name", ["page_jump_ratio", "page_jump_ratio_reversed", "job_page_jump_ratio"])
def test_the_page_ratio_scans_once(spark, name):
    assert plan(BATCH[name](spark, SF_DIR)).count("FileScan") == 1


def test_the_category_job_scans_and_joins_once(spark, monkeypatch):
    seen = []
    kept = jobs.store
    monkeypatch.setattr(jobs, "store", lambda df, name: seen.append(plan(df)) or kept(df, name))
    text = plan(BATCH["job_category_session_top10"](spark, SF_DIR))
    assert len(seen) == 1 and "events.parquet" not in text and "customer.parquet" not in text
    assert seen[0].count("events.parquet") == 1


def test_the_area_report_is_not_shuffled_to_meet_the_floors(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # Below the report's estimate, above a row per area.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
        text = plan(BATCH["star_area_product_top3"](spark, SF_DIR))
        assert not re.search(r"Exchange hashpartitioning\((?:coalesce\()?area#\d+[^,]*(?:, )?(?:isnull[^,]*)?, \d+\)", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_the_last_hour_reads_the_log_twice(spark, monkeypatch):
    seen = []
    kept = queries.store
    monkeypatch.setattr(queries, "store", lambda df, name: seen.append(plan(df)) or kept(df, name))
    text = plan(BATCH["last_hour_ad_minutes"](spark, SF_DIR))
    assert sum(p.count("events.parquet") for p in [*seen, text]) == 2


def test_global_top_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(BATCH["category_top10"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["area_product_counts", "category_action_counts", "date_user_ad_counts", "word_count"])
def test_counts_are_combined_before_the_shuffle(spark, name):
    text = plan(BATCH[name](spark, SF_DIR))
    assert "partial_count" in text


@pytest.fixture
def stored(spark, tmp_path):
    data = [
        {"user_id": i % 7, "date": f"2024-01-{i % 28 + 1:02}", "page_id": i % 5, "session_id": "s",
         "click_category_id": i % 3, "action_time": f"2024-01-01 00:00:{i % 60:02}"}
        for i in range(200)
    ]
    write_parquet(actions(spark, data), str(tmp_path / "actions"))
    return read_table(spark, "user_visit_action", str(tmp_path / "actions"))


def test_filters_and_columns_reach_the_scan(spark, stored):
    users = from_rows(spark, "user_info", [(i, "", "", 20 + i, "", "") for i in range(7)])
    params = JobParams.from_mapping({"startDate": "2024-01-05", "endDate": "2024-01-25", "startAge": 22})
    text = category.category_action_counts(select_actions(stored, users, params))
    text = text._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date,2024-01-05)" in text and "LessThanOrEqual(date,2024-01-25)" in text
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in schema.split(",")} == {
        "date", "user_id", "click_category_id", "order_category_ids", "pay_category_ids"
    }


def test_page_jumps_shuffle_their_columns_once(spark, stored):
    text = plan(funnel.page_jumps(stored, [(1, 2)]))
    assert text.count("hashpartitioning(") == 1 and re.search(r"hashpartitioning\(session_id#\d+, \d+\)", text)
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in schema.split(",")} == {"session_id", "page_id", "action_time"}
    assert text.count("FileScan") == 1


def test_page_jumps_of_large_data_shuffle_their_columns_once(spark, stored, monkeypatch):
    seen = {}
    kept = funnel.store
    monkeypatch.setattr(funnel, "store", lambda df, name: seen.update({name: plan(df)}) or kept(df, name))
    text = plan(funnel.page_jumps(stored, [(1, 2)], whole_below=0))
    assert "actions" not in text.split("Location")[0]
    assert len(re.findall(r"hashpartitioning\(session_id#\d+, slice#\d+", seen["session-slices"])) == 1


def test_page_view_filter_reaches_the_scan(spark, stored):
    assert "In(page_id, [1,2])" in funnel.page_views(stored, [1, 2])._jdf.queryExecution().toString()


def test_a_date_range_reads_its_folders_only(spark, tmp_path):
    data = [{"user_id": i % 7, "date": f"2024-01-{i % 28 + 1:02}", "click_category_id": i % 3} for i in range(280)]
    write_parquet(actions(spark, data).repartition(1), str(tmp_path / "actions"), partition_by=["date"])
    stored = read_table(spark, "user_visit_action", str(tmp_path / "actions"))
    users = from_rows(spark, "user_info", [(i, "", "", 20 + i, "", "") for i in range(7)])
    some = select_actions(stored, users, JobParams.from_mapping({"startDate": "2024-01-05", "endDate": "2024-01-07"}))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= 2024-01-05", plan(some))
    # What lies in other folders is not opened: a file that cannot be read does no harm there.
    for file in (tmp_path / "actions/date=2024-01-20").glob("part-*"):
        file.write_bytes(b"no parquet")
    with pytest.raises(Exception, match="CANNOT_READ|not a Parquet"):
        select_actions(stored, users, JobParams()).toArrow()
    assert rows(some.groupBy("date").count()) == [(f"2024-01-0{d}", 10) for d in (5, 6, 7)]


def test_tables_bucketed_by_user_meet_without_a_shuffle(spark, tmp_path):
    data = [{"user_id": 1 if i % 3 else i, "click_category_id": i % 5} for i in range(600)]
    people = from_rows(spark, "user_info", [(i, "", "", 20 + i % 40, "", "") for i in range(600)])
    for name, frame in (("user_visit_action", actions(spark, data)), ("user_info", people)):
        replace_table(frame, f"{name}_b", bucket_by=["user_id"], buckets=4, path=str(tmp_path / name))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = select_actions(
            read_table(spark, "user_visit_action", table="user_visit_action_b"),
            read_table(spark, "user_info", table="user_info_b"),
            JobParams.from_mapping({"endAge": 50}),
        )
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        expected = sum(1 for row in data if 20 + row["user_id"] % 40 <= 50)
        assert joined.count() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("user_visit_action_b", "user_info_b"):
            spark.sql(f"drop table {name}")


def test_logs_of_users_not_listed_are_not_shuffled(spark, tmp_path):
    write_parquet(spark.range(1000).selectExpr("concat('u', id) as userid", "0L as listed_batch"), str(tmp_path / "listed"))
    logs = spark.range(4000).selectExpr("concat('u', id) as userid", "id % 2 as batch_id")
    write_parquet(logs, str(tmp_path / "logs"))
    listed, logs = (spark.read.parquet(str(tmp_path / x)) for x in ("listed", "logs"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = ads.drop_blacklisted(logs, listed)
        left = joins.without(logs, listed, "userid")
        for frame in (kept, left):
            # One branch of the union joins by sorting; the other is not shuffled at all.
            text = plan(frame)
            rest = text[text.rindex("Project", 0, text.rindex("logs]")) :]
            assert text.count("Join LeftAnti") + text.count("SortMergeJoin") >= 1 and "BroadcastHashJoin" in text
            assert "hashpartitioning(userid" not in rest.split("BroadcastExchange")[0]
        assert kept.count() == 3500 and left.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert ads.drop_blacklisted(logs, listed).count() == 3500 and joins.without(logs, listed, "userid").count() == 3000


def test_only_small_tables_are_broadcast(spark, tmp_path):
    write_parquet(spark.range(1000), str(tmp_path / "ids"))
    ids = spark.read.schema("id long").parquet(str(tmp_path / "ids"))
    assert "ResolvedHint" in lookup(ids)._jdf.queryExecution().analyzed().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for value in ("1000", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert "ResolvedHint" not in lookup(ids)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_hot_user_is_split_where_the_users_are_not_broadcast(spark, tmp_path):
    """More than a third of all actions are one user's; the users count as large here."""
    data = [{"user_id": 1 if i % 5 < 2 else i, "session_id": f"session-{i}"} for i in range(60_000)]
    write_parquet(actions(spark, data).repartition(16), str(tmp_path / "actions"))
    frame = read_table(spark, "user_visit_action", str(tmp_path / "actions"))
    users = from_rows(spark, "user_info", [(i, "", "", 20, "", "") for i in range(60_000)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = select_actions(frame, users, JobParams())
        assert len(joined.select("session_id").toArrow()) == 60_000
        joined = joined.select("session_id")
        joined.toArrow()
        assert re.search(r"SortMergeJoin.*skew=true", plan(joined))
        assert rows(joined.groupBy().count()) == [(60_000,)]
    finally:
        for key in settings:
            spark.conf.unset(key)
