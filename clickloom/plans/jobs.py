"""The batch jobs: read, compute, stamp with the task id, hand over to a writer.

A writer is called as ``write(df, result_name)``, for instance
``lambda df, name: append_jdbc(df, jdbc_options(url, name))``.
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from clickloom.operators import actions as act
from clickloom.operators import area, category, funnel
from clickloom.session import store
from clickloom.sinks.tables import stamp
from clickloom.sources.params import JobParams

Writer = Callable[[DataFrame, str], None]

# Fixed prefixes of the task ids.
CATEGORY_TASK = "One-"
SESSION_TASK = "Two-"
JUMP_TASK = "Three-"
AREA_TASK = "Four--"


def new_task_id(prefix: str) -> str:
    """Prefix and current epoch milliseconds; one id for all rows of a run."""
    return f"{prefix}{time.time_ns() // 1_000_000}"


def category_job(actions: DataFrame, users: DataFrame, params: JobParams, write: Writer) -> None:
    """Writes ``category_top10`` and ``category_session_top10``.

    The actions are read, joined with the users and counted per category and session
    once; both results follow from the stored counts.
    """
    counts = store(
        category.category_session_actions(act.select_actions(actions, users, params)), "category-sessions"
    )
    top = category.top_categories(category.counts_of_categories(counts))
    columns = ["category_id", "click_count", "order_count", "pay_count"]
    write(stamp(top.select(*columns), new_task_id(CATEGORY_TASK)), "category_top10")
    sessions = category.top_category_sessions(category.clicks_of_sessions(counts), top)
    write(stamp(sessions, new_task_id(SESSION_TASK)), "category_session_top10")


def page_jump_job(actions: DataFrame, params: JobParams, write: Writer, **ordering) -> None:
    """Writes ``jump_page_ratio`` over all actions."""
    ratios = funnel.page_jump_ratio(actions, params.page_flow, **ordering)
    write(stamp(ratios, new_task_id(JUMP_TASK)), "jump_page_ratio")


def area_job(actions: DataFrame, cities: DataFrame, products: DataFrame, write: Writer) -> None:
    """Writes ``area_count_info``."""
    top = area.area_product_top(area.city_product_counts(actions, cities, products))
    write(stamp(top, new_task_id(AREA_TASK)), "area_count_info")
