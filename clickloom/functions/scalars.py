"""Scalar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed label of the remainder in the city share text; its colon is full-width.
OTHER_CITIES_LABEL = "其他："


def composite_key(*parts: str) -> Column:
    """Key parts as one text, such as ``area:city:ad`` or ``user:ad``."""
    return F.concat_ws(":", *parts)


def event_date(millis: Column) -> Column:
    """``yyyy-MM-dd`` of epoch milliseconds in the session zone."""
    return F.timestamp_millis(millis).cast("date").cast("string")


def event_minute(millis: Column) -> Column:
    """``HH:mm`` of epoch milliseconds in the session zone."""
    return F.date_format(F.timestamp_millis(millis), "HH:mm")


def one_decimal(tenths: Column) -> Column:
    """Round a number of tenths half up and return it in units."""
    return F.floor(tenths + F.lit(0.5)).cast("double") / F.lit(10.0)


def percent(part: Column, whole: Column) -> Column:
    """Share of ``part`` in ``whole`` in percent, rounded half up to one decimal."""
    return one_decimal(part.cast("double") * F.lit(1000.0) / whole.cast("double"))


def city_share_text(
    first_city: Column,
    first_percent: Column,
    second_city: Column,
    second_percent: Column,
) -> Column:
    """``c1:p1%,c2:p2%,<others>p%``; the second city may be missing (null percent).

    The remainder is always present and is 100 less the *rounded* shares, so it
    can come out as -0.1 when both shares were rounded up.
    """

    def part(city: Column, share: Column) -> Column:
        named = F.concat(F.coalesce(city, F.lit("null")), F.lit(":"), share.cast("string"), F.lit("%"))
        return F.when(share.isNotNull(), named)

    rest = F.lit(100.0) - first_percent - F.coalesce(second_percent, F.lit(0.0))
    others = F.concat(F.lit(OTHER_CITIES_LABEL), one_decimal(rest * F.lit(10.0)).cast("string"), F.lit("%"))
    return F.concat_ws(",", part(first_city, first_percent), part(second_city, second_percent), others)
