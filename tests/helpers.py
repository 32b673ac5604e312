"""Small inputs for the tests."""

from clickloom.schemas import NOT_A_CLICK, USER_VISIT_ACTION
from clickloom.sources.tables import from_rows


def actions(spark, rows):
    """Actions from dicts; what is left out is null, or "not a click"."""
    empty = dict.fromkeys(USER_VISIT_ACTION.names) | {
        "click_category_id": NOT_A_CLICK,
        "click_product_id": NOT_A_CLICK,
    }
    return from_rows(spark, "user_visit_action", [tuple((empty | row).values()) for row in rows])


def clicks(category, times=1, **more):
    return [{"click_category_id": category, **more}] * times


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*(columns or df.columns)).collect())


def log_line(millis, user, ad, area="N", city="c"):
    return f"{millis} {area} {city} {user} {ad}"


DAY = 86_400_000
