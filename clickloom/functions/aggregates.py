"""Aggregate expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_pairs(key: Column, value: Column, *order: Column) -> Column:
    """JSON text ``[{"key":value},...]`` of a group, sorted by ``order``.

    It holds the group in one row: only for groups of a known size, such as the
    top three of a group or the minutes of a day.
    """
    names = [f"o{i}" for i in range(len(order))]
    entry = F.struct(*[o.alias(n) for o, n in zip(order, names)], key.alias("k"), value.alias("v"))
    ordered = F.array_sort(F.collect_list(entry))
    return F.to_json(F.transform(ordered, lambda e: F.create_map(e["k"], e["v"])))
