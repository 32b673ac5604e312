"""The input tables, derived from the star-schema test tables.

``k`` is the integer in ``events.props``. See FIXTURES.md for the derivation.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup
from clickloom.schemas import NOT_A_CLICK

PARAMS = {
    "startDate": "2024-01-05",
    "endDate": "2024-01-25",
    "startAge": "20",
    "endAge": "50",
    "targetPageFlow": "1,2,3,4,5,6,7",
}
BLACKLIST_THRESHOLD = 3
WINDOW_MINUTES = 60
# A unique last column, so that equal action times have an order.
ACTION_ORDER = ("action_time", "event_id")
MILLIS_PER_DAY = 86_400_000


# Columns in use. A declared schema spares the look into the files before planning.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_type string",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": "l_orderkey long, l_partkey long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, props string",
    "documents": "doc_id long, text string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _when_type(event_type: str, value: Column, otherwise: Column | None = None) -> Column:
    chosen = F.when(F.col("event_type") == event_type, value)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def _two_categories(step: int) -> Column:
    return F.concat_ws(",", _k() % 20 + 1, (_k() + step) % 20 + 1)


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    no_click = F.lit(NOT_A_CLICK)
    return _read(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        F.concat(F.lit("s"), F.col("user_id")).alias("session_id"),
        (_k() % 10 + 1).cast("long").alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        _when_type("view", F.concat(F.lit("kw"), _k() % 6)).alias("search_keyword"),
        _when_type("click", _k() % 20 + 1, no_click).cast("long").alias("click_category_id"),
        _when_type("click", F.col("event_id") % 100, no_click).cast("long").alias("click_product_id"),
        _when_type("signup", _two_categories(7)).alias("order_category_ids"),
        none.alias("order_product_ids"),
        _when_type("purchase", _two_categories(3)).alias("pay_category_ids"),
        none.alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user_"), F.col("c_custkey")).alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + F.col("c_custkey") % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(F.col("c_custkey") % 2 == 0, "female").otherwise("male").alias("gender"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("extend_info"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ads_log_lines(spark: SparkSession, sf_dir: str, batch_days: int = 1) -> DataFrame:
    """All events as log lines (batch_id, event_type, value).

    ``batch_id`` numbers the replay batches of ``batch_days`` whole days.
    """
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    cities = city_info(spark, sf_dir).withColumnRenamed("city_id", "home_city_id")
    events = _read(spark, sf_dir, "events").select(
        millis.alias("millis"),
        F.col("user_id"),
        "event_type",
        (F.col("user_id") % 25).alias("home_city_id"),
        (_k() % 6 + 1).alias("adid"),
    )
    return events.join(lookup(cities), "home_city_id").select(
        F.floor(F.col("millis") / F.lit(MILLIS_PER_DAY * batch_days)).alias("batch_id"),
        "event_type",
        F.concat_ws(
            " ", "millis", F.replace("area", F.lit(" "), F.lit("_")), "city_name", "user_id", "adid"
        ).alias("value"),
    )


def star_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as clicks: product = part, city = nation of the customer."""
    lineitem = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_nationkey").cast("long").alias("city_id"),
        F.col("l_partkey").alias("click_product_id"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, as a line source would deliver it."""
    lines = F.explode(F.split("text", "\n"))
    return _read(spark, sf_dir, "documents").select("doc_id", lines.alias("value"))
