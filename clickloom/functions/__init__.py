"""Column expressions shared by the operators; all run inside the JVM."""

from clickloom.functions.aggregates import json_pairs
from clickloom.functions.scalars import (
    city_share_text,
    composite_key,
    event_date,
    event_minute,
    one_decimal,
    percent,
)

__all__ = [
    "city_share_text",
    "composite_key",
    "event_date",
    "event_minute",
    "json_pairs",
    "one_decimal",
    "percent",
]
