"""Product popularity per area with the share of the leading cities."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import city_share_text, percent
from clickloom.operators.joins import lookup
from clickloom.operators.ranking import top_values_with_ties
from clickloom.session import store

GROUP = ["area", "product_name"]


def city_product_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per area, product name and city.

    Actions are counted per city and product id *before* the dimension joins: the
    joins then see at most cities x products rows, and a hot product one per city.
    Rows that are not clicks have no product and fall out of the join.
    """
    per_id = (
        actions.where(F.col("city_id").isNotNull() & F.col("click_product_id").isNotNull())
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count("*").alias("n"))
    )
    cities = cities.select("city_id", "city_name", "area")
    products = products.select("product_id", "product_name")
    named = per_id.join(lookup(cities), "city_id").join(lookup(products), "product_id")
    return named.groupBy(*GROUP, "city_name").agg(F.sum("n").alias("clicks"))


def area_product_counts(city_counts: DataFrame) -> DataFrame:
    """Clicks per area and product name."""
    return city_counts.groupBy(*GROUP).agg(F.sum("clicks").alias("product_count"))


def city_click_ratio(city_counts: DataFrame) -> DataFrame:
    """Clicks per area and product name with the share text of the two leading cities.

    Cities with equal counts are taken in name order. A group has one row per city of
    the area here, so its window is as small as the city table.
    """
    by_clicks = Window.partitionBy(*GROUP).orderBy(F.desc("clicks"), F.asc_nulls_last("city_name"))
    whole_group = by_clicks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_city = city_counts.select(
        *GROUP,
        "city_name",
        "clicks",
        F.lead("city_name").over(by_clicks).alias("next_city"),
        F.lead("clicks").over(by_clicks).alias("next_clicks"),
        F.sum("clicks").over(whole_group).alias("product_count"),
        F.row_number().over(by_clicks).alias("position"),
    ).where(F.col("position") == 1)
    text = city_share_text(
        F.col("city_name"),
        percent(F.col("clicks"), F.col("product_count")),
        F.col("next_city"),
        percent(F.col("next_clicks"), F.col("product_count")),
    )
    return first_city.select(*GROUP, "product_count", text.alias("city_click_ratio"))


def area_product_top(city_counts: DataFrame, n: int = 3) -> DataFrame:
    """Products ranked ``n`` or better by clicks in their area, with the city shares.

    Equal counts share a rank, so an area may have more than ``n`` rows. The counts, at
    most cities x products rows, are written out, since the ranks and the report need them.
    """
    city_counts = store(city_counts, "city-counts")
    return top_values_with_ties(
        city_click_ratio(city_counts), ["area"], "product_count", n, area_product_counts(city_counts)
    )
