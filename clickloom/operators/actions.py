"""Selecting and classifying user actions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup
from clickloom.schemas import NOT_A_CLICK
from clickloom.sources.params import JobParams


def select_actions(actions: DataFrame, users: DataFrame, params: JobParams) -> DataFrame:
    """Actions of known users within the optional inclusive date and age ranges.

    Dates compare as text, ages as numbers. Each side is filtered before the join,
    so the date range reaches the scan of the fact table and the age range shrinks
    the user side, which Spark then broadcasts if it is small enough.
    """
    for bound, keep in (
        (params.start_date, lambda v: F.col("date") >= v),
        (params.end_date, lambda v: F.col("date") <= v),
    ):
        if bound is not None:
            actions = actions.where(keep(bound))
    for bound, keep in (
        (params.start_age, lambda v: F.col("age") >= v),
        (params.end_age, lambda v: F.col("age") <= v),
    ):
        if bound is not None:
            users = users.where(keep(bound))
    return actions.join(lookup(users.select("user_id")), "user_id").select(*actions.columns)


def is_click() -> Column:
    """A missing category counts as "not a click"."""
    return F.coalesce(F.col("click_category_id"), F.lit(NOT_A_CLICK)) != NOT_A_CLICK


def category_actions(actions: DataFrame, *keep: str) -> DataFrame:
    """One row (kind, category_id and the columns ``keep``) per category touched by an action.

    The first matching kind wins: a click, else the ordered categories, else the
    paid ones. Empty list elements are dropped.
    """
    orders, payments = F.col("order_category_ids"), F.col("pay_category_ids")
    kind = F.when(is_click(), "click").when(orders.isNotNull(), "order").when(payments.isNotNull(), "pay")
    categories = (
        F.when(is_click(), F.array(F.col("click_category_id").cast("string")))
        .when(orders.isNotNull(), F.split(orders, ","))
        .when(payments.isNotNull(), F.split(payments, ","))
    )
    touched = actions.select(*keep, kind.alias("kind"), F.explode(categories).alias("category_id"))
    return touched.where(F.col("category_id") != "")
