"""Category popularity and the busiest sessions per category."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.actions import category_actions, is_click
from clickloom.operators.ranking import top_rows


def category_action_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category; a kind that never occurs is 0."""
    return category_actions(actions).groupBy("category_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def category_session_actions(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category and session; both reports follow from it."""
    return category_actions(actions, "session_id").groupBy("category_id", "session_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def counts_of_categories(session_actions: DataFrame) -> DataFrame:
    """The counts of ``category_action_counts`` from those per session."""
    kinds = ("click_count", "order_count", "pay_count")
    return session_actions.groupBy("category_id").agg(*[F.sum(k).alias(k) for k in kinds])


def clicks_of_sessions(session_actions: DataFrame) -> DataFrame:
    """The counts of ``session_clicks`` from those of all kinds."""
    return session_actions.where("click_count > 0").select("category_id", "session_id", "click_count")


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most payments, then orders, then clicks.

    Remaining ties go to the smaller category_id (as text).
    """
    return counts.orderBy(
        F.desc("pay_count"), F.desc("order_count"), F.desc("click_count"), F.asc("category_id")
    ).limit(n)


def session_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per category and session."""
    return (
        actions.where(is_click())
        .groupBy(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
        .agg(F.count("*").alias("click_count"))
    )


def top_category_sessions(session_counts: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """Per given category, the ``n`` sessions with most clicks.

    Ties go to the smaller session_id. Spark moves the semi-join below the counting,
    so only clicks on the given categories are counted.
    """
    chosen = session_counts.join(categories.select("category_id"), "category_id", "left_semi")
    return top_rows(
        chosen, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n
    ).drop("position")
