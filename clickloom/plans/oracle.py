"""SQL with the same results as the queries, for checking them in another engine.

Written apart from the operators: the rank, the page order and the blacklist are
stated here in the plainest form, not in the form that scales.
"""

from clickloom.sources import testdata as td

K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

CTES = {
    "actions": f"""
        select event_id,
               strftime(ts, '%Y-%m-%d') as date,
               user_id,
               's' || user_id as session_id,
               cast({K} % 10 + 1 as bigint) as page_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as action_time,
               case when event_type = 'view' then 'kw' || ({K} % 6) end as search_keyword,
               cast(case when event_type = 'click' then {K} % 20 + 1 else -1 end as bigint) as click_category_id,
               cast(case when event_type = 'click' then event_id % 100 else -1 end as bigint) as click_product_id,
               case when event_type = 'signup'
                    then ({K} % 20 + 1) || ',' || (({K} + 7) % 20 + 1) end as order_category_ids,
               cast(null as varchar) as order_product_ids,
               case when event_type = 'purchase'
                    then ({K} % 20 + 1) || ',' || (({K} + 3) % 20 + 1) end as pay_category_ids,
               cast(null as varchar) as pay_product_ids,
               user_id % 25 as city_id
        from events""",
    "cities": """
        select cast(n_nationkey as bigint) as city_id, n_name as city_name, r_name as area
        from nation join region on n_regionkey = r_regionkey""",
    "clicked": """
        select area, p_name as product_name, city_name
        from actions join cities using (city_id) join part on click_product_id = p_partkey""",
    "star_clicked": """
        select r_name as area, p_name as product_name, n_name as city_name
        from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        join part on l_partkey = p_partkey""",
    "selected": f"""
        select actions.* from actions join customer on user_id = c_custkey
        where date between '{td.PARAMS["startDate"]}' and '{td.PARAMS["endDate"]}'
          and 10 + c_custkey % 50 between {td.PARAMS["startAge"]} and {td.PARAMS["endAge"]}""",
    "touched": """
        select 'click' as kind, cast(click_category_id as varchar) as category_id
        from selected where click_category_id <> -1
        union all
        select 'order', unnest(string_split(order_category_ids, ',')) from selected
        where click_category_id = -1 and order_category_ids is not null
        union all
        select 'pay', unnest(string_split(pay_category_ids, ',')) from selected
        where click_category_id = -1 and order_category_ids is null and pay_category_ids is not null""",
    "category_counts": """
        select category_id,
               count(*) filter (kind = 'click') as click_count,
               count(*) filter (kind = 'order') as order_count,
               count(*) filter (kind = 'pay') as pay_count
        from touched group by category_id""",
    "top_categories": """
        select * from category_counts
        order by pay_count desc, order_count desc, click_count desc, category_id limit 10""",
    "session_counts": """
        select cast(click_category_id as varchar) as category_id, session_id, count(*) as click_count
        from selected where click_category_id <> -1 group by all""",
    "flow": """
        select * from (values (1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7)) as f(page, next_page)""",
    "views": """
        select page_id, count(*) as views from actions where page_id in (select page from flow) group by page_id""",
    "moves": """
        select page_id as from_page,
               lead(page_id) over (partition by session_id order by action_time, event_id) as to_page
        from actions""",
    "move_counts": "select from_page, to_page, count(*) as jumps from moves group by all",
    "lines": f"""
        select epoch_us(ts) // 1000 as timestamp,
               replace(area, ' ', '_') as area,
               city_name as city,
               cast(user_id as varchar) as userid,
               cast({K} % 6 + 1 as varchar) as adid,
               event_type
        from events join cities on user_id % 25 = city_id""",
}


def _logs(days: int) -> str:
    """The log with its date and replay batch of whole days."""
    return f"""
        select timestamp, area, city, userid, adid,
               strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') as date,
               cast(timestamp // {td.MILLIS_PER_DAY * days} as bigint) as batch_id
        from lines"""


CTES |= {
    "logs": _logs(1),
    "batch_counts": """
        select batch_id, date, userid, adid, count(*) as clicks from logs group by all""",
    "running": """
        select *, cast(sum(clicks) over (partition by date, userid, adid order by batch_id) as bigint)
                  as running_clicks
        from batch_counts""",
    "blacklist": f"""
        select userid, min(batch_id) as listed_batch
        from running where running_clicks >= {td.BLACKLIST_THRESHOLD} group by userid""",
    "kept": """
        select logs.* from logs left join blacklist using (userid)
        where listed_batch is null or batch_id <= listed_batch""",
    "city_ad_counts": """
        select date, area, city, adid, count(*) as clicks from kept group by all""",
    "ad_counts": """
        select date, area, adid, count(*) as clicks from kept group by all""",
    "top_ads": """
        select * from (
            select *, row_number() over (partition by date, area order by clicks desc, adid) as position
            from ad_counts)
        where position <= 3""",
    "recent": f"""
        select adid, strftime(make_timestamp(timestamp * 1000), '%H:%M') as minute, count(*) as clicks
        from kept
        where timestamp > (select max(timestamp) from kept) - {td.WINDOW_MINUTES * 60_000}
        group by all""",
}


def _with(names: str, body: str, stream_days: int | dict | None = None) -> str:
    """``stream_days``: days per batch, or parts to use instead of the usual ones."""
    other = stream_days if isinstance(stream_days, dict) else {"logs": _logs(stream_days)} if stream_days else {}
    parts = CTES | other
    ctes = ",\n".join(f"{name} as ({parts[name]})" for name in names.split())
    return f"with {ctes}\n{body}"


def _shares(clicked: str, keep_rank: int | None) -> str:
    """Product counts with the city shares; only the ranked ones if ``keep_rank`` is given."""
    ranked = f"where rank <= {keep_rank}" if keep_rank else ""
    tenths = "floor(c.n * cast(1000 as double) / t.n + cast(0.5 as double)) / cast(10 as double)"
    return f"""
    , city_counts as (select area, product_name, city_name, count(*) as n from {clicked} group by all),
    totals as (
        select area, product_name, count(*) as n, rank() over (partition by area order by count(*) desc) as rank
        from {clicked} group by area, product_name),
    ordered as (
        select *, row_number() over (partition by area, product_name order by n desc, city_name) as pos
        from city_counts),
    shares as (
        select c.area, c.product_name, t.n, t.rank, c.pos, c.city_name, {tenths} as share
        from ordered c join totals t on c.area = t.area and c.product_name = t.product_name
        where c.pos <= 2),
    wide as (
        select area, product_name, n, rank,
               max(city_name) filter (pos = 1) as c1, max(share) filter (pos = 1) as s1,
               max(city_name) filter (pos = 2) as c2, max(share) filter (pos = 2) as s2
        from shares group by area, product_name, n, rank)
    select area, product_name, n as product_count,
           c1 || ':' || s1 || '%,' || coalesce(c2 || ':' || s2 || '%,', '') || '其他：' ||
           (floor((cast(100 as double) - s1 - coalesce(s2, cast(0 as double))) * cast(10 as double)
                  + cast(0.5 as double)) / cast(10 as double)) || '%' as city_click_ratio
    from wide {ranked}"""


def _jump_ratio(from_page: str, to_page: str) -> str:
    return f"""
        select page || '-' || next_page as page_jump, cast(jumps as double) / coalesce(views, 1) as ratio
        from flow join move_counts on from_page = {from_page} and to_page = {to_page}
        left join views on page_id = page"""


def _json(key: str, value: str, order: str) -> str:
    """``[{"key":value},...]`` over a group."""
    return f"""'[' || string_agg('{{"' || {key} || '":' || {value} || '}}', ',' order by {order}) || ']'"""


JUMPS = "actions flow views moves move_counts"
LOGS = "cities lines logs"
KEPT = f"{LOGS} batch_counts running blacklist kept"
WORDS = """
    select word, count(*) as n from (
        select unnest(string_split(replace(text, chr(10), ' '), ' ')) as word from documents)
    where word <> '' group by word"""
TOP_ADS_JSON = f"""
    select date, area, {_json("adid", "clicks", "position")} as top_ads from top_ads group by date, area"""
RECENT_JSON = f"select adid, {_json('minute', 'clicks', 'minute')} as minutes from recent group by adid"

# Days per replay batch, as in the streaming queries.
STREAM_DAYS = 10

ORACLE_SQL = {
    "area_product_counts": _with(
        "actions cities clicked",
        "select area, product_name, count(*) as product_count from clicked group by all",
    ),
    "city_click_ratio": _with("actions cities clicked", _shares("clicked", None)),
    "area_product_top3": _with("actions cities clicked", _shares("clicked", 3)),
    "star_area_product_top3": _with("star_clicked", _shares("star_clicked", 3)),
    "star_city_click_ratio": _with("star_clicked", _shares("star_clicked", None)),
    "session_filtered_actions": _with("actions selected", "select * from selected"),
    "category_action_counts": _with("actions selected touched category_counts", "select * from category_counts"),
    "category_top10": _with(
        "actions selected touched category_counts top_categories", "select * from top_categories"
    ),
    "category_session_counts": _with("actions selected session_counts", "select * from session_counts"),
    "category_session_top10": _with(
        "actions selected touched category_counts top_categories session_counts",
        """
        select category_id, session_id, click_count from (
            select *, row_number() over (partition by category_id order by click_count desc, session_id) as pos
            from session_counts where category_id in (select category_id from top_categories))
        where pos <= 10""",
    ),
    "page_view_counts": _with("actions flow views", "select page_id, views from views"),
    "page_jump_counts": _with(
        JUMPS,
        """
        select from_page, to_page, jumps from move_counts join flow on from_page = page and to_page = next_page""",
    ),
    "page_jump_ratio": _with(JUMPS, _jump_ratio("page", "next_page")),
    "page_jump_ratio_reversed": _with(JUMPS, _jump_ratio("next_page", "page")),
    "ads_log_parsed": _with(LOGS, "select timestamp, area, city, userid, adid, date from logs"),
    "ads_log_quarantine": _with(
        "cities lines",
        """
        select timestamp || ' ' || area || ' ' || city || ' ' || userid as value
        from lines where event_type = 'error'""",
    ),
    "date_user_ad_batch_counts": _with(f"{LOGS} batch_counts running", "select * from running"),
    "ad_blacklist": _with(f"{LOGS} batch_counts running blacklist", "select * from blacklist"),
    "ads_after_blacklist": _with(KEPT, "select batch_id, timestamp, area, city, userid, adid from kept"),
    "date_user_ad_counts": _with(
        KEPT, "select date, userid, adid, count(*) as clicks from kept group by all"
    ),
    "date_area_city_ad_counts": _with(f"{KEPT} city_ad_counts", "select * from city_ad_counts"),
    "date_area_ad_counts": _with(f"{KEPT} ad_counts", "select * from ad_counts"),
    "top3_ads_per_area_day": _with(
        f"{KEPT} ad_counts top_ads",
        "select date, area, adid, clicks, cast(position as int) as position from top_ads",
    ),
    "top3_ads_per_area_day_json": _with(f"{KEPT} ad_counts top_ads", TOP_ADS_JSON),
    "last_hour_ad_minutes": _with(f"{KEPT} recent", "select * from recent"),
    "last_hour_ad_minutes_json": _with(f"{KEPT} recent", RECENT_JSON),
    "word_count": WORDS,
    "stream_ads_pipeline_counts": _with(
        f"{KEPT} city_ad_counts", "select area, city, adid, clicks, date from city_ad_counts", STREAM_DAYS
    ),
    "stream_user_ad_counts": _with(
        KEPT, "select date, userid, adid, count(*) as clicks from kept group by all", STREAM_DAYS
    ),
    "stream_ad_blacklist": _with(
        f"{LOGS} batch_counts running blacklist",
        """
        , numbered as (select batch_id, row_number() over (order by batch_id) - 1 as number
                       from (select distinct batch_id from logs))
        select userid, number as listed_batch from blacklist join numbered on listed_batch = batch_id""",
        STREAM_DAYS,
    ),
    "stream_top3_ads": _with(f"{KEPT} ad_counts top_ads", TOP_ADS_JSON, STREAM_DAYS),
    "stream_last_hour_ads": _with(f"{KEPT} recent", RECENT_JSON, STREAM_DAYS),
    "stream_word_count": WORDS,
}

_ON_TIME = CTES["lines"].rstrip() + " where event_type <> 'error'"
_BY_USER = _logs(1).replace(
    f"timestamp // {td.MILLIS_PER_DAY}", "cast(userid as bigint) % 3"
)
ORACLE_SQL |= {
    "date_partitioned_category_counts": ORACLE_SQL["category_action_counts"],
    "user_bucketed_category_counts": ORACLE_SQL["category_action_counts"],
    "page_jump_counts_sliced": ORACLE_SQL["page_jump_counts"],
    "job_category_top10": ORACLE_SQL["category_top10"],
    "job_category_session_top10": ORACLE_SQL["category_session_top10"],
    "job_page_jump_ratio": ORACLE_SQL["page_jump_ratio"],
    "job_area_count_info": ORACLE_SQL["area_product_top3"],
    "date_area_city_ad_keys": _with(
        f"{KEPT} city_ad_counts",
        "select date, area || ':' || city || ':' || adid as field, cast(clicks as varchar) as value from city_ad_counts",
    ),
    "stream_late_and_future_clicks": _with(
        f"{KEPT} city_ad_counts",
        "select area, city, adid, clicks, date from city_ad_counts",
        {"lines": _ON_TIME, "logs": _BY_USER},
    ),
}
