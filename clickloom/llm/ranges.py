"""Ranks and running totals over rows that no single task could sort.

Rows are dealt to sorted ranges, each task adds up its range from row to row, and both are
written out with the number of the range. What comes before each range is then a sum over
one row per range. The last sort key should tell all rows apart (a row number), so that no
set of equal rows is too large for one range.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup
from clickloom.session import store


def _add_up(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(names, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            for name in names:
                place = batch.schema.get_field_index(name)
                sums = np.cumsum(batch.column(place).to_numpy(zero_copy_only=False)) + total[name]
                total[name] = sums[-1]
                batch = batch.set_column(place, name, pa.array(sums))
            yield batch

    return run


def running(df: DataFrame, order: Sequence[Column], totals: dict[str, Column]) -> DataFrame:
    """``df`` with, for each of ``totals`` (long, never null), the sum over all rows up to
    and including each row in ``order``."""
    names = list(totals)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(*df.columns, F.spark_partition_id().alias("_range"), *[c.alias(k) for k, c in totals.items()])
    ranges = store(dealt.mapInArrow(_add_up(names), dealt.schema), "sorted-ranges")
    sums = ranges.groupBy("_range").agg(*[F.max(k).alias(f"_{k}") for k in names])
    # One row per range.
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in names])
    met = ranges.join(lookup(store(starts, "range-starts")), "_range")
    return met.select(*df.columns, *[(F.col(k) + F.col(f"_{k}")).alias(k) for k in names])
