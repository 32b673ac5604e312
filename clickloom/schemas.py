"""Fixed schemas of the input tables, the ad-click stream and the stream state."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


USER_VISIT_ACTION = _schema(
    date=T.StringType(),
    user_id=T.LongType(),
    session_id=T.StringType(),
    page_id=T.LongType(),
    action_time=T.StringType(),
    search_keyword=T.StringType(),
    click_category_id=T.LongType(),
    click_product_id=T.LongType(),
    order_category_ids=T.StringType(),
    order_product_ids=T.StringType(),
    pay_category_ids=T.StringType(),
    pay_product_ids=T.StringType(),
    city_id=T.LongType(),
)

USER_INFO = _schema(
    user_id=T.LongType(),
    username=T.StringType(),
    name=T.StringType(),
    age=T.IntegerType(),
    professional=T.StringType(),
    gender=T.StringType(),
)

PRODUCT_INFO = _schema(
    product_id=T.LongType(),
    product_name=T.StringType(),
    extend_info=T.StringType(),
)

CITY_INFO = _schema(
    city_id=T.LongType(),
    city_name=T.StringType(),
    area=T.StringType(),
)

# One ad click. `timestamp` is epoch milliseconds.
ADS_LOG = _schema(
    timestamp=T.LongType(),
    area=T.StringType(),
    city=T.StringType(),
    userid=T.StringType(),
    adid=T.StringType(),
)

TABLES = {
    "user_visit_action": USER_VISIT_ACTION,
    "user_info": USER_INFO,
    "product_info": PRODUCT_INFO,
    "city_info": CITY_INFO,
}

# click_category_id / click_product_id of a row that is not a click.
NOT_A_CLICK = -1
